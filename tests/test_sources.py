"""Files in and out."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from matflow import sources as src
from testbed.scratch import scratch_folder

DAY1, DAY2 = dt.date(2024, 1, 2), dt.date(2024, 1, 9)


def day(value):
    return F.lit(value)


def test_record_lines_with_run_date(spark, tmp_path):
    folder = tmp_path / "2023" / "12.12"
    folder.mkdir(parents=True)
    (folder / "po.csv").write_text("GLB-RP-1~00026~x~y~5~P1~2024-01-02~z\n\nshort~1\n")
    other = tmp_path / "no date"
    other.mkdir()
    (other / "po.csv").write_text("a~b\n")
    got = src.read_record_lines(spark, str(folder), str(other)).collect()
    assert sorted((r.line, r.as_of) for r in got if r.as_of) == [
        ("GLB-RP-1~00026~x~y~5~P1~2024-01-02~z", dt.date(2023, 12, 12)),
        ("short~1", dt.date(2023, 12, 12)),
    ]
    assert [r.line for r in got if r.as_of is None] == ["a~b"]


def test_numbered_lines_drop_number_and_header(spark, tmp_path):
    folder = tmp_path / "01.02.2024"
    folder.mkdir()
    (folder / "a.csv").write_text('"","x"\n"1","a~b"\n"2","c~d"\n')
    (folder / "b.csv").write_text('"","x"\n"1","e~f"\n')
    got = src.read_numbered_lines(spark, str(folder)).collect()
    assert sorted(tuple(r) for r in got) == [("a~b", DAY1), ("c~d", DAY1), ("e~f", DAY1)]


def grid(spark):
    rows = [
        (DAY1, 1, "title", None),
        (DAY1, 2, "B/P", "Item Number"),
        (DAY1, 3, "26", "7"),
        (DAY2, 1, None, None),
        (DAY2, 2, "Item Number", "B/P"),
        (DAY2, 3, "8", "55"),
        (DAY2, 4, "9", "25"),
    ]
    return spark.createDataFrame(rows, "as_of date, row_no int, c1 string, c2 string")


def test_promote_header(spark):
    one = grid(spark).filter(F.col("as_of") == DAY1).drop("as_of")
    got = src.promote_header(one, 2)
    assert got.columns == ["b_p", "item_number"]
    assert [tuple(r) for r in got.collect()] == [("26", "7")]
    with pytest.raises(ValueError, match="row 9"):
        src.promote_header(one, 9)


def test_promote_header_per_run(spark):
    rows = spark.createDataFrame([(DAY1, 2), (DAY2, 2)], "as_of date, header_row int")
    got = src.promote_header_per_run(grid(spark), rows).select("as_of", "b_p", "item_number")
    assert sorted(tuple(r) for r in got.collect()) == [
        (DAY1, "26", "7"),
        (DAY2, "25", "9"),
        (DAY2, "55", "8"),
    ]


def test_header_rows_differ_by_run_and_must_be_there(spark):
    rows = spark.createDataFrame([(DAY1, 1), (DAY2, 3)], "as_of date, header_row int")
    got = src.promote_header_per_run(grid(spark), rows)
    assert got.columns == ["as_of", "x8", "x55", "title", "na"]
    assert sorted((r.as_of, r.x8, r.title) for r in got.collect() if r.as_of == DAY2) == [(DAY2, "9", None)]
    late = spark.createDataFrame([(DAY1, 9), (DAY2, 2)], "as_of date, header_row int")
    with pytest.raises(ValueError, match="2024, 1, 2"):
        src.promote_header_per_run(grid(spark), late)


def test_two_headers_are_an_error(spark):
    with pytest.raises(ValueError, match="found 2"):
        src.promote_header(grid(spark).drop("as_of"), 2)


def test_sheet_to_header(spark):
    rows = [("RM", 1, "loc", "item"), ("RM", 2, "1", "2"), ("FG", 1, "x", "y")]
    sheets = spark.createDataFrame(rows, "sheet string, row_no int, c1 string, c2 string")
    got = src.promote_header(src.named_sheet(sheets, "RM"), 1)
    assert got.columns == ["loc", "item"] and [tuple(r) for r in got.collect()] == [("1", "2")]


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("file:/a/12.12.2023/po.csv", dt.date(2023, 12, 12)),
        ("file:/a/2023/12.12.23/po.csv", dt.date(2023, 12, 12)),
        ("file:/a/6.8.23/po.csv", dt.date(2023, 6, 8)),
        ("file:/a/2023/12.12/po.csv", dt.date(2023, 12, 12)),
        ("file:/a/01.02.2024/po 01.09.24.csv", dt.date(2024, 1, 2)),
        ("file:/a/week/report 1.9.2024.csv", DAY2),
        ("file:/a/v1.2.3.4/po.csv", None),
        ("file:/a/po.csv", None),
    ],
)
def test_run_date_of_a_path(spark, path, expected):
    df = spark.createDataFrame([(path,)], "path string")
    assert df.select(src.as_of_from_path(F.col("path"))).first()[0] == expected


def test_quotes_backslashes_and_commas_in_records(spark, tmp_path):
    (tmp_path / "new.csv").write_text('"","x"\n"1","a~5"" pipe~c"\n"2","a~q\\"\n"3","d, e~f"\n')
    got = src.read_numbered_lines(spark, str(tmp_path / "new.csv"), as_of=F.lit(DAY1)).collect()
    assert sorted(tuple(r) for r in got) == [('a~5" pipe~c', DAY1), ("a~q\\", DAY1), ("d, e~f", DAY1)]
    (tmp_path / "old.csv").write_text('"a~5"" pipe~c"\n"d, e~f"\ng~h,second field\n')
    got = src.read_record_lines(spark, str(tmp_path / "old.csv"), as_of=F.lit(DAY1)).collect()
    assert sorted(r.line for r in got) == ['a~5" pipe~c', "d, e~f", "g~h"]


def test_empty_rerun_clears_its_run_dates(spark, tmp_path):
    root, schema = str(tmp_path), "ref string, as_of date"
    src.publish(spark.createDataFrame([("a", DAY1), ("b", DAY2)], schema), root, "po")
    src.publish(spark.createDataFrame([], schema), root, "po", run_dates=[DAY1])
    assert [tuple(r) for r in src.read_published(spark, root, "po").collect()] == [("b", DAY2)]
    src.publish(spark.createDataFrame([("c", DAY1)], schema), root, "po", run_dates=[DAY1, DAY2])
    assert [tuple(r) for r in src.read_published(spark, root, "po").collect()] == [("c", DAY1)]


def test_rows_without_a_run_date_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="no run date"):
        src.publish(spark.createDataFrame([("a", None)], "ref string, as_of date"), str(tmp_path), "po")


def test_declared_columns(spark):
    df = spark.createDataFrame([(1, "x", 2)], "campus int, extra string, location int")
    got = src.enforce(df, "campus")
    assert got.columns == ["location", "campus", "extra"]
    assert tuple(got.first()) == ("2", "1", "x")
    with pytest.raises(ValueError, match="location"):
        src.enforce(df.drop("location"), "campus")


def test_publish_replaces_only_its_run_dates(spark, tmp_path):
    root = str(tmp_path)
    src.publish(spark.createDataFrame([("a",), ("b",)], "ref string"), root, "po", day(DAY1))
    both = spark.createDataFrame([("c", DAY1), ("d", DAY2)], "ref string, as_of date")
    src.publish(both.filter(F.col("as_of") == DAY2), root, "po")
    src.publish(spark.createDataFrame([("e", DAY2)], "ref string, as_of date"), root, "po", cluster=True)
    got = src.read_published(spark, root, "po").collect()
    assert sorted((r.ref, r.as_of) for r in got) == [("a", DAY1), ("b", DAY1), ("e", DAY2)]


def test_several_tables_under_one_root(spark, tmp_path):
    po = spark.createDataFrame([("a", "1")], "ref string, po_no string")
    receipt = spark.createDataFrame([("b", "R1")], "ref string, receipt_no string")
    src.publish_tables({"po": po, "receipt": receipt}, str(tmp_path), day(DAY1))
    got = src.read_tables(spark, str(tmp_path), "po", "receipt").collect()
    assert sorted((r.table, r.ref, r.po_no or r.receipt_no, r.as_of) for r in got) == [
        ("po", "a", "1", DAY1),
        ("receipt", "b", "R1", DAY1),
    ]


def test_snapshot_of_the_month_before(spark):
    runs = spark.createDataFrame([(dt.date(2024, 1, 9),), (dt.date(2024, 3, 5),)], "as_of date")
    days = [(2023, 12, 4), (2023, 12, 1), (2024, 1, 2), (2024, 3, 1)]
    snapshots = spark.createDataFrame([(dt.date(*d),) for d in days], "snapshot_date date")
    got = {r.as_of: r.snapshot_date for r in src.select_snapshot(runs, snapshots).collect()}
    assert got == {dt.date(2024, 1, 9): dt.date(2023, 12, 1), dt.date(2024, 3, 5): None}


def test_scratch_folder_is_shared_and_fresh(spark):
    def session(master, shared):
        conf = SimpleNamespace(get=lambda name, default: shared)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    cluster = session("yarn", "hdfs://nn/scratch/")
    first, second = scratch_folder(cluster), scratch_folder(cluster)
    assert first.startswith("hdfs://nn/scratch/matflow-") and first != second
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(session("yarn", None))
    assert scratch_folder(spark) != scratch_folder(spark)
