"""Workbooks (xlsx) as a Spark data source: ``spark.read.format("workbook")`` and ``df.write.format("workbook")``.

Reading gives one row for each sheet row that has a cell: (file, sheet, row_no, cells). A task reads one sheet of one
file, or several small ones, as a stream: in memory are a piece of the sheet and the file's table of shared texts.
Pieces whose rows are laid out as the writer does it are read by columns, all others by an XML parser. Writing takes
rows (file, sheet, cells), where the cells are as column expressions make them, with a byte for each piece of markup, in
order of file; a task streams them into files below a temporary folder, which get their names when the whole job has
succeeded.

Files are reached by the file system of their address (``pyarrow.fs``), on the driver and on the executors.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zipfile
from array import array
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import cached_property, reduce
from types import SimpleNamespace
from xml.etree import ElementTree
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS = "file string, sheet string, row_no bigint, cells array<string>"
#: Fixed values of the file format: rows of a sheet, and number formats that show dates or times.
SHEET_ROWS = 1_048_576
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
#: Bytes of a batch (a cell counts 32 and its characters), of a sheet that are parsed at once, and that are read by columns.
BATCH_BYTES, CHUNK, PIECE = 1 << 22, 1 << 16, 1 << 20
#: Bytes that are parsed at once where only the first rows are wanted.
TOP = 1 << 12
#: Bytes in files that one task reads of small sheets, what opening a sheet counts, and tasks that are enough.
PACK, OPEN, TASKS = 1 << 23, 1 << 16, 128
#: Different numbers, dates and booleans of a kind that a reader remembers.
SEEN = 1 << 16

_ARROW_ROWS = pa.schema(
    [("file", pa.string()), ("sheet", pa.string()), ("row_no", pa.int64()), ("cells", pa.list_(pa.string()))]
)


#: Markup as the writer makes it, and the byte that stands for each: ones that don't occur in UTF-8.
_MARKUP = [
    b'<c t="inlineStr"><is><t xml:space="preserve">',
    *(b"</t></is></c>", b"</v></c>", b"</row>", b"<row>", b"<c/>"),
    *(b"<c><v>", b'<c s="1"><v>', b'<c s="2"><v>', b'<c t="b"><v>'),
]
_MARKS = bytes(range(0xF5, 0xF5 + len(_MARKUP)))
_TEXT, _TEXT_CLOSED, _VALUE_CLOSED, _ROW_CLOSED, _ROW, _EMPTY, *_VALUES = range(len(_MARKUP))


# --- files ------------------------------------------------------------------------------------


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _workbook_files(path: str) -> list[str]:
    """The workbooks in a folder and its subfolders, or the one file; not hidden ones, locks or unfinished files."""
    system, base = _located(path)
    if (info := system.get_file_info(base)).type == fs.FileType.File:
        return [base]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(base, recursive=True))
    named = [x.path for x in found if x.type == fs.FileType.File and x.base_name.lower().endswith(".xlsx")]
    hidden = re.compile(r"(^|/)[._~]")
    return sorted(name for name in named if not hidden.search(name.removeprefix(base)))


# --- reading ----------------------------------------------------------------------------------


def _local(name: str) -> str:
    return name.rpartition(":")[2].rpartition("}")[2]


class _Names(dict):
    """Names without their prefix, each looked up once."""

    def __missing__(self, name: str) -> str:
        return self.setdefault(name, _local(name))


class _Columns(dict):
    """Column numbers by their letters."""

    def __missing__(self, letters: str) -> int:
        return self.setdefault(letters, reduce(lambda n, letter: 26 * n + ord(letter) - 64, letters, 0))


_WHOLE = re.compile(r"-?\d{1,18}")


def _parser(start, end, text):
    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text

    def refuse(*_: object) -> None:
        raise ValueError("a workbook part must not declare a document type")

    parser.StartDoctypeDeclHandler = refuse
    return parser


def _parsed(stream, parser, chunk: int = CHUNK) -> Iterator[None]:
    """Feeds the parser piece by piece and comes back after each."""
    while piece := stream.read(chunk):
        parser.Parse(piece)
        yield
    parser.Parse(b"", True)
    yield


def _plain(text: str) -> str:
    """Text without the format's escapes of control characters."""
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text) if "_x" in text else text


class _Texts:
    """The shared texts of a workbook as one buffer and offsets."""

    def __init__(self, book: zipfile.ZipFile):
        self.data, self.ends = bytearray(), array("q", [0])
        if "xl/sharedStrings.xml" not in book.namelist():
            return
        pieces: list[str] = []
        state = {"text": False, "phonetic": 0}

        def start(name: str, _: dict) -> None:
            state["phonetic"] += _local(name) == "rPh"
            state["text"] = _local(name) == "t" and not state["phonetic"]

        def end(name: str) -> None:
            state["text"] = False
            state["phonetic"] -= _local(name) == "rPh"
            if _local(name) == "si":
                self.data.extend(_plain("".join(pieces)).encode())
                self.ends.append(len(self.data))
                pieces.clear()

        def text(piece: str) -> None:
            if state["text"]:
                pieces.append(piece)

        with book.open("xl/sharedStrings.xml") as stream:
            for _ in _parsed(stream, _parser(start, end, text)):
                pass

    def __getitem__(self, at: int) -> str:
        return self.data[self.ends[at] : self.ends[at + 1]].decode()


class Workbook:
    """Sheets of one open file."""

    def __init__(self, file):
        self.book = zipfile.ZipFile(file)
        root = self._part("xl/workbook.xml")
        links = {x.get("Id"): x.get("Target") for x in self._part("xl/_rels/workbook.xml.rels")}
        self.sheets: dict[str, str] = {}
        self.seen: dict[tuple[str, int], tuple[pa.Array, pa.Array]] = {}
        self.later_epoch = False
        for element in root.iter():
            if _local(element.tag) == "sheet":
                link = next(v for k, v in element.attrib.items() if _local(k) == "id")
                target = links[link]
                self.sheets[element.get("name")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            elif _local(element.tag) == "workbookPr":
                self.later_epoch = element.get("date1904") in ("1", "true")

    @cached_property
    def texts(self) -> _Texts:
        return _Texts(self.book)

    @cached_property
    def dates(self) -> set[int]:
        return self._date_styles()

    def _part(self, name: str) -> ElementTree.Element:
        return ElementTree.fromstring(self.book.read(name))

    def _date_styles(self) -> set[int]:
        """Cell styles that show a date or a time."""
        if "xl/styles.xml" not in self.book.namelist():
            return set()
        root, custom, found = self._part("xl/styles.xml"), set(DATE_FORMATS), set()
        for element in root.iter():
            if _local(element.tag) == "numFmt":
                shown = re.sub(r'"[^"]*"|\\.|\[(?!h|m|s)[^\]]*\]', "", element.get("formatCode", "").lower())
                if re.search("[ymdhs]", shown) and "general" not in shown:
                    custom.add(int(element.get("numFmtId")))
            elif _local(element.tag) == "cellXfs":
                found = {n for n, x in enumerate(element) if int(x.get("numFmtId", 0)) in custom}
        return found

    def _date(self, serial: float) -> str | None:
        days, seconds = divmod(round(serial * 86_400), 86_400)
        if not self.later_epoch and (days == 60 or days < 0):  # a day that never was
            return None
        if self.later_epoch:
            day = datetime(1904, 1, 1)
        else:
            day = datetime(1899, 12, 31) if days < 60 else datetime(1899, 12, 30)
        try:
            moment = day + timedelta(days=days, seconds=seconds)
        except OverflowError:
            return None
        if days == 0 and seconds and not self.later_epoch:
            return moment.strftime("%H:%M:%S")
        return moment.isoformat(" ") if seconds else moment.date().isoformat()

    @staticmethod
    def _number(text: str) -> str:
        """The number as short as it can be written: binary noise such as 1.1000000000000001 goes."""
        if _WHOLE.fullmatch(text):
            return text
        value = float(text)
        return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)

    def _sheet_parser(self):
        """A parser, its place, with the number of the last row, and the rows done: (row number, cells) of those with a cell."""
        texts, dates = self.texts, self.dates
        names, columns = _Names(), _Columns()
        at, done = SimpleNamespace(row=0), []
        cells, column, kind, style = [], 0, "n", 0
        pieces: list[str] = []
        reading, phonetic = False, 0

        def start(tag: str, attributes: dict) -> None:
            nonlocal cells, column, kind, style, reading, phonetic
            name = names[tag]
            if name == "c":
                kind, style = attributes.get("t", "n"), int(attributes.get("s", 0))
                letters = attributes["r"].rstrip("0123456789") if "r" in attributes else ""
                column = columns[letters] if letters else column + 1
            elif name == "row":
                at.row, cells, column = int(attributes.get("r", at.row + 1)), [], 0
            elif name == "rPh":
                phonetic += 1
            reading = name == "v" or name == "t" and not phonetic

        def end(tag: str) -> None:
            nonlocal reading, phonetic
            name, reading = names[tag], False
            if name == "rPh":
                phonetic -= 1
            elif name == "c":
                value = "".join(pieces)
                pieces.clear()
                if value or kind == "inlineStr":
                    if column > len(cells):
                        cells.extend([None] * (column - len(cells)))
                    cells[column - 1] = self._cell(kind, value, style in dates, texts)
            elif name == "row" and any(cell is not None for cell in cells):
                done.append((at.row, cells))

        def text(piece: str) -> None:
            if reading:
                pieces.append(piece)

        return _parser(start, end, text), at, done

    def size(self, sheet: str) -> int:
        """Bytes of the sheet in the file."""
        return self.book.getinfo(self.sheets[sheet]).compress_size

    def rows(self, sheet: str, chunk: int = CHUNK) -> Iterator[tuple[int, list[str | None]]]:
        """(row number, cells) of the rows with a cell; a cell that shows an error counts as empty."""
        parser, _, done = self._sheet_parser()
        with self.book.open(self.sheets[sheet]) as stream:
            for _ in _parsed(stream, parser, chunk):
                yield from done
                done.clear()

    def tables(self, sheet: str) -> Iterator[tuple[pa.Array, pa.Array] | list[tuple[int, list[str | None]]]]:
        """The same rows piece by piece: numbers and cells as arrays, or a list of rows once a piece is not regular.

        The parser gets all but the regular pieces, so it still sees whether the sheet is well-formed.
        """
        parser, at, done = self._sheet_parser()
        with self.book.open(self.sheets[sheet]) as stream:
            rest = stream.read(CHUNK)
            head = rest[: rest.find(_DATA) + len(_DATA)] if _DATA in rest else b""
            if regular := _is_plain_head(head):
                parser.Parse(head)
                rest = rest[len(head) :]
            while regular:
                more = stream.read(PIECE)
                rest += more
                if end := rest.rfind(_ROW_END) + 1:
                    end += len(_ROW_END) - 1
                    if table := _regular_rows(rest[:end], at.row, self._converted):
                        count, *arrays = table
                        yield tuple(arrays)
                        at.row += count
                        rest = rest[end:]
                    else:
                        regular = False
                regular = regular and more and len(rest) <= 16 * PIECE
            parser.Parse(rest)
            yield done
            done.clear()
            for _ in _parsed(stream, parser):
                yield done
                done.clear()

    def _converted(self, cell: tuple[str, int], values: pa.Array) -> pa.Array:
        """Values of cells of one kind and style; what was looked up before is remembered."""
        kind, style = cell
        keys, shown = self.seen.get(cell, (values[:0], values[:0]))
        places = pc.index_in(values, keys)
        if places.null_count:
            new = values.filter(places.is_null()).unique()
            if len(keys) + len(new) > SEEN:
                keys, shown, new = keys[:0], shown[:0], values.unique()
            found = [self._cell(kind, x, style in self.dates, self.texts) if x else None for x in new.to_pylist()]
            keys, shown = pa.concat_arrays([keys, new]), pa.concat_arrays([shown, pa.array(found, pa.string())])
            self.seen[cell] = keys, shown
            places = pc.index_in(values, keys)
        return shown.take(places)

    def _cell(self, kind: str, value: str, is_date: bool, texts: _Texts) -> str | None:
        if kind == "s":
            return texts[int(value)]
        if kind in ("inlineStr", "str"):
            return _plain(value)
        if kind == "b":
            return "TRUE" if value in ("1", "true") else "FALSE"
        if kind == "e":
            return None
        if kind == "d":
            return value.replace("T", " ")
        return self._date(float(value)) if is_date else self._number(value)


_DATA, _ROW_END = b"<sheetData>", _MARKUP[_ROW_CLOSED]
#: Type and style of the cells with a value.
_KINDS = dict(zip(_VALUES, [("n", 0), ("n", 1), ("n", 2), ("b", 0)]))
_OPEN = np.isin(np.arange(16), [_TEXT, *_VALUES])
_CELL = np.isin(np.arange(16), [_TEXT, *_VALUES, _EMPTY])
#: 16 x one mark + the mark after it. What may follow a mark depends on nothing before it.
_FOLLOWS = np.zeros(256, bool)
for _cells_may_follow in (_TEXT_CLOSED, _VALUE_CLOSED, _EMPTY, _ROW):
    _FOLLOWS[[16 * _cells_may_follow + mark for mark in (_TEXT, *_VALUES, _EMPTY, _ROW_CLOSED)]] = True
_FOLLOWS[[16 * _ROW_CLOSED + _ROW, 16 * _TEXT + _TEXT_CLOSED, *(16 * mark + _VALUE_CLOSED for mark in _VALUES)]] = True
#: The ampersand comes last: what it gives is not read again.
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def _is_plain_head(head: bytes) -> bool:
    """Whether a sheet up to its rows is UTF-8 without comments, document types and the like."""
    declared = re.match(rb"<\?xml [^<>?]*\?>", head)
    encoding = re.search(rb"encoding\s*=\s*[\"']([^\"']*)", declared[0]) if declared else None
    plain = b"<!" not in head and head.count(b"<?") == bool(declared) and head.count(b"sheetData") == 1
    return plain and (encoding is None or encoding[1].lower() == b"utf-8")


def _regular_rows(piece: bytes, row: int, converted) -> tuple[int, pa.Array, pa.Array] | None:
    """How many rows a piece has, and numbers (after ``row``) and cells of those with a cell.

    None if anything in it is not laid out as the writer does it, or is no XML at all. ``converted`` gives the texts
    of numbers, dates and booleans.
    """
    if not piece.isascii():
        try:
            piece.decode()
        except UnicodeDecodeError:
            return None
        if any(x in piece for x in _NO_CHARACTERS):
            return None
    short = pa.array([piece], pa.binary())
    for n, markup in enumerate(_MARKUP):
        short = pc.replace_substring(short, markup, _MARKS[n : n + 1])
    piece = short[0].as_py()
    entities = piece.count(b"&")
    if b"<" in piece or b">" in piece or _has_control(piece):
        return None
    if entities and entities != sum(piece.count(x.encode()) for x in _ENTITIES):
        return None
    data = np.frombuffer(piece, np.uint8)
    at = np.flatnonzero(data >= _MARKS[0])
    marks = data[at] - _MARKS[0]
    lengths = np.diff(at) - 1
    if at[0] or marks[0] != _ROW or not _FOLLOWS[16 * marks[:-1] + marks[1:]].all() or lengths[~_OPEN[marks[:-1]]].any():
        return None

    cell = _CELL[marks]
    kinds, lengths = marks[cell], lengths[cell[:-1]]
    offsets = np.zeros(len(kinds) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    text = piece.translate(None, _MARKS)
    values = pa.Array.from_buffers(pa.string(), len(kinds), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
    for entity, character in _ENTITIES.items() if entities else ():
        values = pc.replace_substring(values, entity, character)
    if b"_x" in text:
        odd = pc.and_(pa.array(kinds == _TEXT), pc.match_substring(values, "_x"))
        values = pc.replace_with_mask(values, odd, pa.array([_plain(x) for x in values.filter(odd).to_pylist()], pa.string()))
    for kind, shown in _KINDS.items():
        if (here := kinds == kind).any():
            values = pc.replace_with_mask(values, pa.array(here), converted(shown, values.filter(pa.array(here))))
    held = (kinds == _TEXT) | (lengths > 0)
    if not held.all():
        values = pc.if_else(pa.array(held), values, None)

    # A row ends with its last cell that holds something, and one without a value is left out.
    before = np.append(np.cumsum(cell)[marks == _ROW], len(kinds))
    starts, ends = before[:-1], before[1:]
    known = np.append(0, np.cumsum(values.is_valid().to_numpy(False)))
    whole = known[ends] > known[starts]
    if not held.all():
        last = np.append(0, np.maximum.accumulate(np.where(held, np.arange(1, len(kinds) + 1), 0)))
        until = np.maximum(last[ends], starts)
        values = values.filter(pa.array(np.arange(len(kinds)) < np.repeat(until, ends - starts)))
        before = np.append(0, np.cumsum(until - starts))
    cells = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), values)
    numbers = pa.array(np.arange(row + 1, row + 1 + len(starts)))
    if not whole.all():
        cells, numbers = cells.filter(pa.array(whole)), numbers.filter(pa.array(whole))
    return len(starts), numbers, cells


@dataclass
class _Sheets(InputPartition):
    """Sheets that one task reads: (file, sheet)."""

    sheets: list[tuple[str, str]]


def _packed(sizes: Mapping[tuple[str, str], int], tasks: int) -> list[_Sheets]:
    """Sheets by task: small ones together, up to a bound and as long as more than ``tasks`` remain."""
    most, packs, size = min(PACK, sum(sizes.values()) // tasks), [], 0
    for sheet, more in sizes.items():
        if not packs or size + more > most:
            packs.append([])
            size = 0
        packs[-1].append(sheet)
        size += more
    return [_Sheets(pack) for pack in packs]


class _Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.path, self.only = options["path"], options.get("sheet")
        self.first = int(options["first"]) if "first" in options else None

    def partitions(self) -> Sequence[_Sheets]:
        """The names and the sizes of the sheets come from the small directory part of each file."""
        system, _ = _located(self.path)

        def sheets(file: str) -> dict[tuple[str, str], int]:
            with system.open_input_file(file) as opened:
                book = Workbook(opened)
            names = [name for name in book.sheets if self.only in (None, name)]
            return {(file, name): OPEN + (book.size(name) if self.first is None else 0) for name in names}

        with ThreadPoolExecutor(16) as pool:
            sizes = {k: v for found in pool.map(sheets, _workbook_files(self.path)) for k, v in found.items()}
        return _packed(sizes, TASKS if self.first is None else 1)

    def read(self, partition: _Sheets) -> Iterator[pa.RecordBatch]:
        for file, sheet in partition.sheets:
            yield from self._read(file, sheet)

    def _read(self, file: str, sheet: str) -> Iterator[pa.RecordBatch]:
        system, _ = _located(self.path)
        rows: list[tuple[int, list[str | None]]] = []
        size = 0

        def batch(numbers: pa.Array, cells: pa.Array) -> pa.RecordBatch:
            names = (pa.repeat(name, len(numbers)) for name in (file, sheet))
            return pa.RecordBatch.from_arrays([*names, numbers, cells], schema=_ARROW_ROWS)

        def listed() -> pa.RecordBatch:
            return batch(*(pa.array(c, f.type) for c, f in zip(zip(*rows), list(_ARROW_ROWS)[2:])))

        with system.open_input_file(file) as opened:
            book = Workbook(opened)
            for done in book.tables(sheet) if self.first is None else self._top(book, sheet):
                if isinstance(done, tuple):
                    yield batch(*done)
                    continue
                for row, values in done:
                    rows.append((row, values))
                    size += sum(32 + len(value or "") for value in values)
                    if size >= BATCH_BYTES:
                        yield listed()
                        rows, size = [], 0
        if rows:
            yield listed()

    def _top(self, book: Workbook, sheet: str) -> Iterator[list[tuple[int, list[str | None]]]]:
        """Rows up to the last one wanted; they stand in order of their numbers."""
        for row, values in book.rows(sheet, TOP):
            if row <= self.first:
                yield [(row, values)]
            if row >= self.first:
                return


# --- writing ----------------------------------------------------------------------------------

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
# Cell styles: 0 plain, 1 date, 2 date and time.
_STYLES = (
    f'{_HEAD}<styleSheet xmlns="{_MAIN}"><numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/>'
    '<numFmt numFmtId="165" formatCode="yyyy\\-mm\\-dd\\ hh:mm:ss"/></numFmts><fonts count="1"><font/></fonts>'
    '<fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="165" applyNumberFormat="1"/>'
    "</cellXfs></styleSheet>"
)


# What looks like an escape of the format, and characters that XML can't hold.
_LIKE_ESCAPE, _CONTROL = "_(?=x[0-9A-Fa-f]{4}_)", re.compile(r"[\x00-\x08\x0b-\x1f\ufffe\uffff]")
_LIKE_ESCAPE_BYTES = re.compile(_LIKE_ESCAPE.encode())
_CONTROL_BYTES, _NO_CHARACTERS = bytes([*range(9), *range(11, 32)]), ("\ufffe".encode(), "\uffff".encode())


def _has_control(data: bytes) -> bool:
    if not data or np.frombuffer(data, np.uint8).min() >= 32:
        return False
    return len(data.translate(None, _CONTROL_BYTES)) < len(data)


def _without_control(text: str) -> str:
    return _CONTROL.sub(lambda m: f"_x{ord(m[0]):04X}_", text)


def _escaped(text: str) -> str:
    return escape(_without_control(re.sub(_LIKE_ESCAPE, "_x005F_", text)))


def _joined(rows: pa.Array) -> bytes:
    """All rows one after another, as they lie in the array: texts are XML already, bytes have marks for it and plain texts."""
    _, ends, data = rows.buffers()
    ends = memoryview(ends).cast("q" if rows.type in (pa.large_string(), pa.large_binary()) else "i")
    joined = data.slice(ends[rows.offset], ends[rows.offset + len(rows)] - ends[rows.offset]).to_pybytes()
    if rows.type in (pa.binary(), pa.large_binary()):
        if b"_x" in joined:
            joined = _LIKE_ESCAPE_BYTES.sub(b"_x005F_", joined)
        for character, entity in ((b"&", b"&amp;"), (b"<", b"&lt;"), (b">", b"&gt;")):
            joined = joined.replace(character, entity)
        for n in reversed(range(len(_MARKUP))):  # the longest last
            joined = joined.replace(_MARKS[n : n + 1], _MARKUP[n])
    odd = _has_control(joined) or not joined.isascii() and any(x in joined for x in _NO_CHARACTERS)
    return _without_control(joined.decode()).encode() if odd else joined


def _cell_xml(cell: Mapping[str, str] | None) -> str:
    """Cells follow one another without addresses, so a missing one is an empty element."""
    if cell is None or cell["value"] is None:
        return "<c/>"
    kind, value = cell["kind"], cell["value"]
    if kind == "s":
        return f'<c t="inlineStr"><is><t xml:space="preserve">{_escaped(value)}</t></is></c>'
    if kind == "b":
        return f'<c t="b"><v>{value}</v></c>'
    style = {"d": ' s="1"', "t": ' s="2"'}.get(kind, "")
    return f"<c{style}><v>{value}</v></c>"


class WorkbookWriter:
    """Streams sheets into a file, one after another; a full sheet goes on in another one with a number."""

    def __init__(self, stream):
        self.book = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, compresslevel=3)
        self.names: list[str] = []
        self.part = None

    def sheet(self, name: str, header: Sequence[str]) -> None:
        self._close_sheet()
        if not 0 < len(name) <= 31 or re.search(r"[\[\]:*?/\\]", name) or name in self.names:
            raise ValueError(f"{name!r} can't be the name of another sheet")
        self.names.append(name)
        self.title, self.header, self.more, self.rows = name, header, 1, 0
        self._open()

    def _open(self) -> None:
        self.part = self.book.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w", force_zip64=True)
        self.part.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.rows = 0
        self.row([{"kind": "s", "value": name} for name in self.header])

    def _make_room(self) -> None:
        if self.rows == SHEET_ROWS:
            title, header, more = self.title, self.header, self.more + 1
            self.sheet(f"{title} {more}", header)
            self.title, self.more = title, more

    def write_rows(self, rows: pa.Array) -> None:
        """Rows as ``_joined`` takes them."""
        while len(rows):
            self._make_room()
            part, rows = rows[: SHEET_ROWS - self.rows], rows[SHEET_ROWS - self.rows :]
            self.part.write(_joined(part))
            self.rows += len(part)

    def row(self, cells: Sequence[Mapping[str, str] | None]) -> None:
        self._make_room()
        self.part.write(f"<row>{''.join(map(_cell_xml, cells))}</row>".encode())
        self.rows += 1

    def _close_sheet(self) -> None:
        if self.part is not None:
            self.part.write(b"</sheetData></worksheet>")
            self.part.close()
            self.part = None

    def close(self) -> None:
        self._close_sheet()
        numbers = range(1, len(self.names) + 1)
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        sheets = "".join(f'<sheet name={quoteattr(t)} sheetId="{n}" r:id="rId{n}"/>' for n, t in zip(numbers, self.names))
        links = "".join(f'<Relationship Id="rId{n}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n in numbers)
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{kind}.worksheet+xml"/>' for n in numbers)
        parts = {
            "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{sheets}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{links}'
            f'<Relationship Id="rId0" Type="{_LINKS}/styles" Target="styles.xml"/></Relationships>',
            "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">'
            f'<Relationship Id="rId1" Type="{_LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="xml" ContentType="application/xml"/>'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{types}</Types>',
        }
        for name, text in parts.items():
            self.book.writestr(name, _HEAD + text)
        self.book.writestr("xl/styles.xml", _STYLES)
        self.book.close()


@dataclass
class _Written(WriterCommitMessage):
    files: dict[str, str]


class _Writer(DataSourceArrowWriter):
    """Files of a job: written below a temporary folder, named at the end, or deleted."""

    def __init__(self, options: Mapping[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.headers: dict[str, list[str]] = json.loads(options["headers"])
        self.temporary = f"_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, base = _located(self.path)
        files: dict[str, str] = {}
        book = stream = current = None
        waiting: list[str] = []

        def next_sheet() -> None:
            name = waiting.pop(0)
            book.sheet(name, self.headers[name])

        def finish() -> None:
            if book is not None:
                while waiting:  # every workbook has all sheets
                    next_sheet()
                book.close()
                stream.close()

        for batch in iterator:
            names, sheets, rows = (batch.column(batch.schema.get_field_index(name)) for name in ("file", "sheet", "cells"))
            others = pc.or_(pc.not_equal(names[1:], names[:-1]), pc.not_equal(sheets[1:], sheets[:-1]))
            starts = [0, *(n + 1 for n in pc.indices_nonzero(others).to_pylist())] if batch.num_rows else []
            for at, end in zip(starts, [*starts[1:], batch.num_rows]):
                file, sheet = names[at].as_py(), sheets[at].as_py()
                if file != current:
                    finish()
                    folder = f"{base}/{self.temporary}/{uuid.uuid4().hex}"
                    system.create_dir(folder, recursive=True)
                    files[file] = f"{folder}/{file}.xlsx"
                    stream = system.open_output_stream(files[file])
                    book, current, waiting, open_sheet = WorkbookWriter(stream), file, list(self.headers), None
                while open_sheet != sheet:
                    open_sheet = waiting[0]
                    next_sheet()
                book.write_rows(rows[at:end])
        finish()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        system, base = _located(self.path)
        files = {name: path for message in messages if message for name, path in message.files.items()}
        existing = set(_workbook_files(self.path)) if system.get_file_info(base).type == fs.FileType.Directory else set()
        targets = {f"{base}/{name}.xlsx": path for name, path in files.items()}
        if not self.overwrite and (clash := existing & targets.keys()):
            raise FileExistsError(f"these workbooks exist already: {sorted(clash)}")
        system.create_dir(base, recursive=True)
        for target, path in targets.items():
            if target in existing:
                system.delete_file(target)
            system.move(path, target)
        if self.overwrite:
            for old in existing - targets.keys():
                system.delete_file(old)
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        system, base = _located(self.path)
        if system.get_file_info(f"{base}/{self.temporary}").type == fs.FileType.Directory:
            system.delete_dir(f"{base}/{self.temporary}")


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, overwrite)


# --- tables -----------------------------------------------------------------------------------


def read_workbooks(spark: SparkSession, path: str, width: int, sheet: str | None = None, first: int | None = None) -> DataFrame:
    """(file, sheet, row_no, c1 ... c``width``) of all workbooks below ``path``, or of one named sheet of each.

    ``row_no`` is the row's number in the sheet; rows without a cell are left out. All cells are text: numbers
    in their shortest form, dates and times in ISO form, booleans as TRUE and FALSE. A cell beyond ``width`` is an error. ``first`` reads the rows up to that
    number only, such as titles and headers: a task then leaves its sheet there.
    """
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("workbook").option("path", path)
    reader = reader if first is None else reader.option("first", first)
    rows = (reader if sheet is None else reader.option("sheet", sheet)).load()
    beyond = (F.size("cells") > width) & F.array_max(F.slice("cells", width + 1, 1 << 14)).isNotNull()
    wide = F.raise_error(F.concat(F.lit(f"a row has more than {width} cells: "), "file", F.lit(" "), "row_no"))
    cells = F.when(beyond, wide.cast("array<string>")).otherwise(F.col("cells"))
    checked = rows.select("file", "sheet", "row_no", cells.alias("cells"))
    return checked.select("file", "sheet", "row_no", *(F.get("cells", F.lit(n)).alias(f"c{n + 1}") for n in range(width)))


def _mark(n: int) -> Column:
    return F.lit(_MARKS[n : n + 1])


def _cell(field: T.StructField) -> Column:
    """A cell as ``_cell_xml`` has it: numbers, dates and times as serial numbers, everything else as text.

    The writer makes the markup of the marks and escapes the texts. A text that is not UTF-8 is an error.
    """
    value = F.col(f"`{field.name}`")
    first = F.lit("1900-03-01").cast("date")
    whole, day, moment, flag = _VALUES

    def marked(before: int, text: Column, after: int) -> Column:
        return F.coalesce(F.concat(_mark(before), text.cast("string").cast("binary"), _mark(after)), _mark(_EMPTY))

    def number(kind: int, text: Column) -> Column:
        return marked(kind, text, _VALUE_CLOSED)

    plain = value.cast("string")
    text = marked(_TEXT, F.validate_utf8(plain) if isinstance(field.dataType, T.StringType) else plain, _TEXT_CLOSED)
    if isinstance(field.dataType, T.BooleanType):
        return number(flag, value.cast("int"))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(value) | F.abs(value).isin(float("inf")), text).otherwise(number(whole, value))
    if isinstance(field.dataType, T.NumericType):  # longer ones would lose digits as numbers
        return F.when(F.length(plain) > 15, text).otherwise(number(whole, value))
    if isinstance(field.dataType, T.DateType):
        return F.when(value < first, text).otherwise(number(day, F.datediff(value, F.lit("1899-12-30").cast("date"))))
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        wall = value.cast("timestamp_ntz")
        seconds = F.timestamp_diff("SECOND", F.lit("1899-12-30").cast("timestamp_ntz"), wall)
        return F.when(wall.cast("date") < first, text).otherwise(number(moment, seconds / 86_400))
    return text


def _dealt(whole: DataFrame, rows: int) -> DataFrame:
    """(file, sheet, cells) with the rows of a file in one partition, in order; long files become several."""
    counts = whole.groupBy("__file", "place").agg(F.count(F.lit(1)).alias("n"))
    files = counts.groupBy("__file").agg(F.ceil(F.max("n") / rows).alias("files"))
    part = F.pmod(F.xxhash64("cells"), F.col("files")) + 1
    numbered = F.concat("__file", F.lit("-"), part.cast("string"))
    # A row for each workbook, all of which the commit lists, too: a join by shuffle would bring a long one to one task.
    named = whole.join(F.broadcast(files), "__file").withColumn("file", F.when(F.col("files") > 1, numbered).otherwise(F.col("__file")))
    return named.repartition("file").sortWithinPartitions("file", "place").select("file", "sheet", "cells")


def write_workbooks(
    tables: Mapping[str, DataFrame], folder: str, file: Column, leave_out: Sequence[str] = (), rows: int = 1_000_000, mode: str = "overwrite"
) -> None:
    """One workbook for each value of ``file`` in any table, with a sheet for each table.

    A file of more than ``rows`` rows of a table becomes several with numbers, so that no task writes more than that
    of a table; rows are dealt by their hash. ``file`` names columns of every table; ``leave_out`` are columns that
    don't become cells. Files appear when all are written: a failure leaves those from before.
    """
    spark = next(iter(tables.values())).sparkSession
    spark.dataSource.register(WorkbookSource)
    kept = {name: [f for f in df.schema if f.name not in leave_out] for name, df in tables.items()}
    parts = [
        df.select(
            file.alias("__file"),
            F.lit(name).alias("sheet"),
            F.lit(place).alias("place"),
            F.concat(_mark(_ROW), *map(_cell, kept[name]), _mark(_ROW_CLOSED)).alias("cells"),
        )
        for place, (name, df) in enumerate(tables.items())
    ]
    dealt = _dealt(reduce(DataFrame.unionByName, parts), rows)
    headers = json.dumps({name: [f.name for f in fields] for name, fields in kept.items()})
    dealt.write.format("workbook").option("path", folder).option("headers", headers).mode(mode).save()
