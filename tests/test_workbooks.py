"""Workbooks: cells of every kind, files that other programs write, failures, and memory."""

from __future__ import annotations

import datetime as dt
import io
import os
import random
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from matflow import sources as src
from matflow.sources import workbooks as wb

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def foreign_workbook(path, sheet, strings="", styles="", properties=""):
    """A workbook as office programs lay it out: shared texts, addresses, styles, and an absolute target."""
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {MAIN} xmlns:r="{LINKS}">{properties}<sheets><sheet name="Other" sheetId="2" r:id="rId9"/>'
            '<sheet name="BoM" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId1" Target="/xl/worksheets/data.xml"/>'
            '<Relationship Id="rId9" Target="worksheets/other.xml"/></Relationships>',
        )
        book.writestr("xl/worksheets/data.xml", f"<worksheet {MAIN}><sheetData>{sheet}</sheetData></worksheet>")
        book.writestr("xl/worksheets/other.xml", f"<worksheet {MAIN}><sheetData/></worksheet>")
        if strings:
            book.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{strings}</sst>")
        if styles:
            book.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")


def test_a_foreign_workbook(spark, tmp_path):
    strings = (
        "<si><t>Item</t></si><si><r><t>two </t></r><r><t>runs</t></r><rPh><t>spoken</t></rPh></si>"
        "<si><t>a_x000D_b &amp; _x005F_x0041_</t></si>"
    )
    styles = (
        '<numFmts><numFmt numFmtId="170" formatCode="[$-409]d\\-mmm;@"/><numFmt numFmtId="171" formatCode="0.0 &quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/><xf numFmtId="21"/></cellXfs>'
    )
    sheet = (
        '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="D2" t="s"><v>1</v></c></row><row r="3"><c r="A3" s="1"/></row>'
        '<row r="5"><c r="A5"><v>12345</v></c><c r="B5"><v>1.1000000000000001</v></c><c r="C5" t="b"><v>1</v></c>'
        '<c r="D5" t="e"><v>#N/A</v></c><c r="E5" t="str"><f>A1&amp;B1</f><v>made</v></c><c r="AA5" t="s"><v>2</v></c></row>'
        '<row><c s="1"><v>45314</v></c><c s="2"><v>45314.75</v></c><c s="3"><v>2.5</v></c><c s="4"><v>0.5</v></c>'
        '<c s="1"><v>59</v></c><c s="1"><v>60</v></c><c s="1"><v>61</v></c><c><v>1E+5</v></c><c t="inlineStr"><is><t/></is></c></row>'
    )
    foreign_workbook(tmp_path / "JDE BoM 01.21.2025.xlsx", sheet, strings, styles)
    (tmp_path / "~$JDE BoM 01.21.2025.xlsx").write_text("a lock")
    grid = src.read_workbooks(spark, str(tmp_path), 27, "BoM")
    rows = {r["row_no"]: r for r in grid.withColumn("as_of", src.as_of_from_path(F.col("file"))).collect()}
    assert rows.keys() == {2, 5, 6} and rows[2]["as_of"] == dt.date(2025, 1, 21)
    cells = {n: [r[f"c{k}"] for k in range(1, 28)] for n, r in rows.items()}
    assert cells[2][:5] == [None, "Item", None, "two runs", None]
    assert cells[5][:5] == ["12345", "1.1", "TRUE", None, "made"] and cells[5][26] == "a\rb & _x0041_"
    assert cells[6][:9] == [
        *("2024-01-23", "2024-01-23 18:00:00", "2.5", "12:00:00"),
        *("1900-02-28", None, "1900-03-01", "100000", ""),
    ]
    assert src.read_workbooks(spark, str(tmp_path), 27).select("sheet").distinct().count() == 1
    with pytest.raises(Exception, match="more than 5 cells"):
        src.read_workbooks(spark, str(tmp_path), 5, "BoM").collect()


def test_later_epoch(tmp_path):
    sheet, styles = '<row><c s="0"><v>1</v></c></row>', '<cellXfs><xf numFmtId="14"/></cellXfs>'
    foreign_workbook(tmp_path / "a.xlsx", sheet, styles=styles, properties='<workbookPr date1904="1"/>')
    with open(tmp_path / "a.xlsx", "rb") as file:
        assert list(wb.Workbook(file).rows("BoM")) == [(1, ["1904-01-02"])]


def test_document_types_are_refused(tmp_path):
    path = tmp_path / "a.xlsx"
    foreign_workbook(path, "")
    with zipfile.ZipFile(path) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    parts["xl/worksheets/data.xml"] = b'<!DOCTYPE x [<!ENTITY a "b">]>' + parts["xl/worksheets/data.xml"]
    with zipfile.ZipFile(path, "w") as book:
        for name, data in parts.items():
            book.writestr(name, data)
    with open(path, "rb") as file, pytest.raises(ValueError, match="document type"):
        list(wb.Workbook(file).rows("BoM"))


def odd_table(spark):
    texts = ["plain", " spaces ", "a<b>&\"c'", "line\nfeed\r\ttab", "\x01\x1f", "_x0041_", "", None, "日本語 😀"]
    rows = [(t, n * 1.1, n, dt.date(2024, 1, 1 + n), dt.datetime(2024, 1, 1, n, 7, 9), n % 2 == 0) for n, t in enumerate(texts)]
    rows += [("nulls", None, None, None, None, None), ("edges", float("inf"), 2**60, dt.date(1800, 1, 1), None, None)]
    return spark.createDataFrame(rows, "t string, x double, n bigint, day date, at timestamp_ntz, flag boolean")


def test_cells_of_every_kind_come_back(spark, tmp_path):
    table = odd_table(spark)
    src.write_workbooks({"All Kinds": table}, str(tmp_path), F.lit("odd"))
    names = ["t", "x", "n", "day", "at", "flag"]
    got = src.promote_header(src.read_workbooks(spark, str(tmp_path), 6).drop("file", "sheet"), 1)
    flag = F.upper(F.col("flag").cast("string"))
    x = F.when(F.col("x") == F.floor("x"), F.col("x").cast("bigint").cast("string")).otherwise(F.col("x").cast("string"))
    x = F.when(F.col("x") == float("inf"), "Infinity").otherwise(x)
    want = table.withColumns({"flag": flag, "x": x, "n": F.col("n").cast("string")})
    want = want.withColumns({"day": F.col("day").cast("string"), "at": F.col("at").cast("string")})
    order = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert order(got.select(*names).collect()) == order(want.select(*names).collect())


def test_tables_are_sheets_of_a_file(spark, tmp_path):
    po = spark.createDataFrame([("01.02.2024", "a"), ("01.09.2024", "b")], "week string, ref string")
    receipt = spark.createDataFrame([("01.09.2024", "c", 1.5)], "week string, ref string, qty double")
    tables = {"RM PO Data": po, "RM Receipt Data": receipt}
    src.write_workbooks(tables, str(tmp_path), F.col("week"), leave_out=["week"])
    assert sorted(os.listdir(tmp_path)) == ["01.02.2024.xlsx", "01.09.2024.xlsx"]
    rows = src.read_workbooks(spark, str(tmp_path), 2).orderBy("file", "sheet", "row_no").collect()
    assert [(r["file"][-15:-5], r["sheet"], r["row_no"], r["c1"], r["c2"]) for r in rows] == [
        ("01.02.2024", "RM PO Data", 1, "ref", None),
        ("01.02.2024", "RM PO Data", 2, "a", None),
        ("01.02.2024", "RM Receipt Data", 1, "ref", "qty"),
        ("01.09.2024", "RM PO Data", 1, "ref", None),
        ("01.09.2024", "RM PO Data", 2, "b", None),
        ("01.09.2024", "RM Receipt Data", 1, "ref", "qty"),
        ("01.09.2024", "RM Receipt Data", 2, "c", "1.5"),
    ]
    with pytest.raises(Exception, match="exist already"):
        src.write_workbooks(tables, str(tmp_path), F.col("week"), leave_out=["week"], mode="append")
    src.write_workbooks({"RM PO Data": po.limit(1)}, str(tmp_path), F.col("week"), leave_out=["week"])
    assert os.listdir(tmp_path) == ["01.02.2024.xlsx"]


def test_many_rows_become_several_files(spark, tmp_path):
    table = spark.range(1000).withColumn("week", F.lit("w"))
    src.write_workbooks({"ids": table}, str(tmp_path), F.col("week"), leave_out=["week"], rows=300)
    assert sorted(os.listdir(tmp_path)) == [f"w-{n}.xlsx" for n in (1, 2, 3, 4)]
    got = src.read_workbooks(spark, str(tmp_path), 1).filter("row_no > 1").select(F.col("c1").cast("bigint")).collect()
    assert sorted(r[0] for r in got) == list(range(1000))


def test_rows_that_are_xml_fill_sheets(monkeypatch):
    monkeypatch.setattr(wb, "SHEET_ROWS", 3)
    stream = io.BytesIO()
    writer = wb.WorkbookWriter(stream)
    writer.sheet("po", ["ref"])
    rows = [f'<row><c t="inlineStr"><is><t>{x}</t></is></c></row>' for x in ("skipped", "a", "b\r", "\uffff", "é", "last")]
    writer.write_rows(wb.pa.array(rows)[1:5])
    writer.write_rows(wb.pa.array(rows, "large_string")[5:])
    writer.close()
    book = wb.Workbook(stream)
    assert [cells[0] for name in book.sheets for _, cells in book.rows(name)] == ["ref", "a", "b\r", "ref", "\uffff", "é", "ref", "last"]


def test_headers_are_read_without_the_rows_below(spark, tmp_path):
    """The second sheet row is broken: who reads it fails, and who reads headers doesn't come there."""
    foreign_workbook(tmp_path / "a.xlsx", "<row><c><v>1</v></c></row>" + " " * 200_000 + "<row><c><v>x</v></c></row>")
    assert [tuple(r)[2:] for r in src.read_workbooks(spark, str(tmp_path), 1, "BoM", first=1).collect()] == [(1, "1")]
    with pytest.raises(Exception, match="could not convert"):
        src.read_workbooks(spark, str(tmp_path), 1, "BoM").collect()


def test_the_header_is_promoted_without_the_rows_below(spark, tmp_path):
    """The second sheet row is broken, and nothing has read it when the columns have their names."""
    foreign_workbook(tmp_path / "a.xlsx", '<row><c t="str"><v>Item</v></c></row>' + " " * 200_000 + "<row><c><v>x</v></c></row>")
    grid, tops = (src.read_workbooks(spark, str(tmp_path), 1, "BoM", n).drop("file", "sheet") for n in (None, 1))
    assert src.promote_header(grid, 1, tops).columns == ["item"]


CELLS = [
    *('<c t="inlineStr"><is><t xml:space="preserve">%s</t></is></c>' % x for x in ("a", "", " é😀 ", "&lt;&amp;lt;&gt;", "_x0041_ _x", "l\nf")),
    *("<c><v>17.0</v></c>", "<c><v>1E+5</v></c>", "<c><v></v></c>", '<c s="1"><v>45314</v></c>', '<c s="1"><v>60</v></c>'),
    *('<c s="2"><v>45314.75</v></c>', '<c t="b"><v>1</v></c>', "<c/>", "<c/>"),
]
ODD = [
    *("<c></c>", '<c r="C1"><v>3</v></c>', '<c t="inlineStr"/>', '<c t="str"><v>x</v></c>', '<c t="e"><v>#N/A</v></c>', "<c> <v>1</v></c>"),
    *("<!--<row>--><c/>", '<c t="inlineStr"><is><t>a</t></is></c>', '<c t="inlineStr"><is><t xml:space="preserve">&#65;></t></is></c>'),
    *('<c t="inlineStr"><is><t xml:space="preserve"><![CDATA[</row><row>]]></t></is></c>', "<c><f>A1</f><v>2</v></c>"),
]
HEAD = f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<worksheet {MAIN}><sheetData>'
DATES = '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="22"/></cellXfs>'


def both_ways(xml: bytes):
    """The rows of a sheet as the parser and as ``tables`` read it (or the kind of error), and whether columns were used."""
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns:r="{LINKS}"><sheets><sheet name="a" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="a.xml"/></Relationships>')
        book.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{DATES}</styleSheet>")
        book.writestr("xl/a.xml", xml)
    pieces = []

    def tables():
        for piece in wb.Workbook(stream).tables("a"):
            pieces.append(type(piece))
            yield from zip(*(x.to_pylist() for x in piece)) if isinstance(piece, tuple) else piece

    found = []
    for read in (lambda: wb.Workbook(stream).rows("a"), tables):
        try:
            found.append(list(read()))
        except Exception as error:
            found.append(type(error))
    return *found, tuple in pieces


def test_columns_and_parser_read_the_same_rows(monkeypatch):
    """Random sheets, some with rows that are laid out otherwise and some that are damaged."""
    draw, by_columns, odd, errors = random.Random(7), 0, 0, 0
    for n in range(600):
        monkeypatch.setattr(wb, "CHUNK", draw.choice([150, 1000]))
        monkeypatch.setattr(wb, "PIECE", draw.choice([50, 300, 5000]))
        monkeypatch.setattr(wb, "SEEN", draw.choice([1, 3, 1 << 16]))
        cells = CELLS + ODD if n % 3 == 1 else CELLS
        rows = ["".join(draw.choices(cells, k=draw.randrange(7))) for _ in range(draw.randrange(40))]
        opened = [draw.choice(["<row>"] * 30 + ['<row r="77">', '<row spans="1:3">']) if n % 3 == 1 else "<row>" for _ in rows]
        xml = (HEAD + "".join(f"{a}{b}</row>" for a, b in zip(opened, rows)) + "</sheetData></worksheet>").encode()
        if n % 3 == 2:
            at, more = draw.randrange(len(xml)), draw.choice([b"", b"<", b">", b"&", b"\xf5", b"\xfa", b"\xff", b"\x01", b"\r", b"</row>", b"<row>", b"</c>", b"<v>"])
            xml = xml[:at] + more + xml[at + draw.randrange(8) :]
        expected, got, columns = both_ways(xml)
        assert got == expected, xml
        by_columns, odd, errors = by_columns + columns, odd + (n % 3 == 1 and not columns), errors + isinstance(got, type)
    assert by_columns > 200 and odd > 20 and errors > 50


@pytest.mark.parametrize(
    "head",
    [
        HEAD.replace("UTF-8", "ISO-8859-1"),
        HEAD.replace("<sheetData>", "<!-- <sheetData> --><sheetData>"),
        HEAD.replace("<sheetData>", "<!-- <sheetData><row></row> --><sheetData>"),
        HEAD.replace("<sheetData>", "<sheetData/><!-- <sheetData> <row></row> --><sheetData>"),
    ],
)
def test_other_heads_are_left_to_the_parser(head):
    row = '<row><c t="inlineStr"><is><t xml:space="preserve">\xe9</t></is></c></row>'
    code = "latin-1" if "ISO" in head else "utf-8"
    expected, got, columns = both_ways((head + row + "</sheetData></worksheet>").encode(code))
    assert expected == got and got[-1][1] == ["\xe9"] and not columns


def test_what_the_writer_writes_is_read_by_columns(spark, tmp_path):
    src.write_workbooks({"All Kinds": odd_table(spark)}, str(tmp_path), F.lit("odd"))
    with open(tmp_path / "odd.xlsx", "rb") as file:
        book = wb.Workbook(file)
        pieces = list(book.tables("All Kinds"))
        got = [row for piece in pieces if isinstance(piece, tuple) for row in zip(*(x.to_pylist() for x in piece))]
        assert len(got) == 12 and got == list(book.rows("All Kinds"))


def test_rows_move_without_their_markup(spark, tmp_path, monkeypatch):
    """Each piece of markup is one byte until the writer has the row."""
    moved = []
    monkeypatch.setattr(wb, "_dealt", lambda whole, rows, dealt=wb._dealt: moved.append(whole) or dealt(whole, rows))
    table = spark.createDataFrame([("é<&_x0041_\t", 1.5, None)], "t string, x double, missing string")
    src.write_workbooks({"a": table}, str(tmp_path), F.lit("w"))
    cells = bytes(moved[0].first()["cells"])
    assert len(cells) == len("é<&_x0041_\t1.5".encode()) + 7
    row = '<row><c t="inlineStr"><is><t xml:space="preserve">é&lt;&amp;_x005F_x0041_\t</t></is></c><c><v>1.5</v></c><c/></row>'
    assert wb._joined(wb.pa.array([cells])) == wb._joined(wb.pa.array([b"", cells], "large_binary")[1:]) == row.encode()
    with zipfile.ZipFile(tmp_path / "w.xlsx") as book:
        assert book.read("xl/worksheets/sheet1.xml").decode().endswith(f"{row}</sheetData></worksheet>")


def test_a_text_that_is_not_utf8_is_refused(spark, tmp_path):
    """It could not be read again, and its bytes might look like markup."""
    table = spark.range(1).select(F.unhex(F.lit("41F6F541")).cast("string").alias("t"))
    with pytest.raises(Exception, match="UTF8"):
        src.write_workbooks({"a": table}, str(tmp_path / "out"), F.lit("w"))
    assert not list(tmp_path.glob("out/*.xlsx"))


def test_one_task_reads_several_small_sheets():
    def sizes(count, size):
        return {(f"{n}.xlsx", "a"): size for n in range(count)}

    packs = wb._packed(sizes(5000, 1_500_000), 128)
    assert [x for pack in packs for x in pack.sheets] == list(sizes(5000, 0)) and {len(x.sheets) for x in packs} == {5}
    assert len(wb._packed(sizes(100, 700_000), 128)) == 100
    assert len(wb._packed(sizes(3, 1 << 30), 1)) == 3 and not wb._packed({}, 128)


def test_a_long_file_is_never_gathered_whole(spark):
    """Its rows move once, by the names of the files that it becomes."""
    whole = spark.range(1000).select(F.when(F.col("id") >= 0, "w").alias("__file"), F.lit("ids").alias("sheet"), F.lit(0).alias("place"), F.array("id").alias("cells"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = wb._dealt(whole.repartition(4), 300)
        text = dealt._jdf.queryExecution().executedPlan().toString()
        held = dealt.groupBy(F.spark_partition_id().alias("task"), "file").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert len(held) == 4 and sum(row["count"] for row in held) == 1000


def test_full_sheets_go_on_in_another(monkeypatch):
    monkeypatch.setattr(wb, "SHEET_ROWS", 3)
    stream = io.BytesIO()
    writer = wb.WorkbookWriter(stream)
    writer.sheet("po", ["ref"])
    for n in range(7):
        writer.row([{"kind": "n", "value": str(n)}])
    writer.close()
    book = wb.Workbook(stream)
    sheets = {name: [cells[0] for _, cells in book.rows(name)] for name in book.sheets}
    assert sheets == {"po": ["ref", "0", "1"], "po 2": ["ref", "2", "3"], "po 3": ["ref", "4", "5"], "po 4": ["ref", "6"]}


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    good = spark.range(10).select(F.lit("old").alias("week"), "id")
    src.write_workbooks({"ids": good}, str(tmp_path), F.col("week"), leave_out=["week"])
    bad = F.when(F.col("id") == 77, F.raise_error(F.lit("no such lot"))).otherwise(F.col("id").cast("string"))
    table = spark.range(100).select(F.concat(F.lit("new"), F.col("id") % 5).alias("week"), bad.alias("id"))
    with pytest.raises(Exception, match="no such lot"):
        src.write_workbooks({"ids": table}, str(tmp_path), F.col("week"), leave_out=["week"])
    assert os.listdir(tmp_path) == ["old.xlsx"]
    assert src.read_workbooks(spark, str(tmp_path), 1).count() == 11


def test_an_error_in_the_writer_leaves_no_file(spark, tmp_path):
    """A task that fails after its first files are whole: they go with the temporary folder."""
    table = spark.createDataFrame([("a", "x"), ("b", "y")], "week string, ref string")
    with pytest.raises(Exception, match="can't be the name"):
        src.write_workbooks({"po": table, "not a [name]": table}, str(tmp_path / "out"), F.col("week"))
    assert not list((tmp_path / "out").glob("**/*.xlsx")) if (tmp_path / "out").exists() else True


MEMORY = """
import resource, sys
from matflow.sources import workbooks as wb
path = sys.argv[1]
text = ("lot %06d " * 100)
with open(path, "wb") as file:
    writer = wb.WorkbookWriter(file)
    writer.sheet("lots", ["a"] * 10)
    for n in range(22_000):
        writer.row([{"kind": "s", "value": text % ((n,) * 100)}] * 10)
    writer.close()
with open(path, "rb") as file:
    book = wb.Workbook(file)
    size = book.book.getinfo("xl/worksheets/sheet1.xml").file_size
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
reader = wb._Reader({"path": path})
rows = sum(batch.num_rows for part in reader.partitions() for batch in reader.read(part))
print(size, rows, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""


def test_a_large_sheet_is_streamed(tmp_path, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", os.pathsep.join(sys.path))
    run = [sys.executable, "-c", MEMORY, str(tmp_path / "large.xlsx")]
    size, rows, more = map(int, subprocess.run(run, capture_output=True, text=True, check=True).stdout.split())
    assert size > 200e6 and rows == 22_001
    assert more < 100_000  # kilobytes; the limit doesn't depend on the size of the sheet
