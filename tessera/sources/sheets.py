"""Worksheets of xlsx files without a reader library: XML parts of a zip, parsed where the file is read, rows in batches."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.stats import finite
from tessera.sources.binary import _files
from tessera.sources.readers import SourceMismatch, require

#: Rows of one batch that the reader hands to Spark.
BATCH_ROWS = 1000
# fixed values: the format's namespaces and the part that holds shared texts
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_SHARED = "xl/sharedStrings.xml"


def _text(item: ElementTree.Element) -> str:
    """Text of a plain or rich string; readings beside it (rPh) do not count."""
    runs = [item.find(_MAIN + "t"), *[r.find(_MAIN + "t") for r in item.findall(_MAIN + "r")]]
    return "".join(t.text or "" for t in runs if t is not None)


def _texts(book: zipfile.ZipFile) -> list[str]:
    if _SHARED not in book.namelist():
        return []
    out = []
    with book.open(_SHARED) as f:
        for _, item in ElementTree.iterparse(f):
            if item.tag == _MAIN + "si":
                out.append(_text(item))
                item.clear()
    return out


def _part(book: zipfile.ZipFile, sheet: str | None) -> str:
    """The zip's name of a sheet, the first one where none is named."""
    sheets = {x.get("name"): x.get(_LINK) for x in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(_MAIN + "sheet")}
    name = next(iter(sheets), None) if sheet is None else sheet
    if name not in sheets:
        raise SourceMismatch(f"no sheet {sheet}")
    links = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    return posixpath.normpath(posixpath.join("/xl", links[sheets[name]])).lstrip("/")


def _column(place: str) -> int:
    """0 for A1, 27 for AB7."""
    n = 0
    for x in place:
        if not x.isalpha():
            break
        n = n * 26 + ord(x.upper()) - ord("A") + 1
    return n - 1


def _cell(cell: ElementTree.Element, texts: list[str]) -> str | None:
    kind, value = cell.get("t"), cell.findtext(_MAIN + "v")
    if kind == "inlineStr":
        inner = cell.find(_MAIN + "is")
        value = None if inner is None else _text(inner)
    elif kind == "e":
        value = None
    elif value is not None and kind == "s":
        value = texts[int(value)]
    elif value is not None and kind == "b":
        value = "true" if value == "1" else "false"
    return value or None


def _lines(raw: bytes, sheet: str | None) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 1, texts by column); empty cells are None, rows without a value are left out."""
    try:
        book = zipfile.ZipFile(io.BytesIO(raw))
    except zipfile.BadZipFile as e:
        raise SourceMismatch("not an xlsx file") from e
    texts, number, held = _texts(book), 0, None
    with book.open(_part(book, sheet)) as f:
        for event, item in ElementTree.iterparse(f, ("start", "end")):
            if event == "start":
                held = item if item.tag == _MAIN + "sheetData" else held
                continue
            if item.tag != _MAIN + "row":
                continue
            number = int(item.get("r") or number + 1)
            out: list[str | None] = []
            for cell in item.iter(_MAIN + "c"):
                at = _column(cell.get("r")) if cell.get("r") else len(out)
                out += [None] * (at + 1 - len(out))
                out[at] = _cell(cell, texts)
            if any(x is not None for x in out):
                yield number, out
            held.clear()  # a parsed row is not needed any more


def sheet_rows(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(file, row, cells) of a sheet of xlsx files: numbers as they are stored, dates as their serial numbers, errors as null.

    A file is one task's; only its shared texts and a batch of rows are held beside its bytes.
    """
    schema = pa.schema([("file", pa.string()), ("row", pa.int64()), ("cells", pa.list_(pa.string()))])

    def parse(batches):
        for batch in batches:
            for file, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                held: list[dict] = []
                for number, cells in _lines(raw.as_py(), sheet):
                    held.append({"file": file, "row": number, "cells": cells})
                    if len(held) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return _files(spark, path, "*.xlsx").mapInArrow(parse, "file string, row long, cells array<string>")


def sheet_table(spark: SparkSession, path: str, columns: dict[str, str], header: int = 1, sheet: str | None = None, numbers: tuple[str, ...] = (), key: str | None = None, located: tuple[str, str] | None = None, rows: int | None = None, width: int | None = None) -> DataFrame:
    """A sheet whose ``header``-th row names its columns: (row, and each of ``columns`` {name here: name there}).

    A name that is missing or stands twice raises. numbers: columns whose text that
    is no number becomes null. key: a column that must be there and unique. located:
    two columns that must be numbers in every row. rows, width: how many rows after
    the header and how many columns there must be.
    """
    raw = sheet_rows(spark, path, sheet)
    head = raw.where(F.col("row") == header).select("file", F.col("cells").alias("_names"))
    once = lambda n: F.size(F.filter("_names", lambda x: x == F.lit(n))) == 1
    rules = {"header": (F.count("*") > 0) & (F.min(F.forall(F.array(*[once(n) for n in columns.values()]), lambda x: x).cast("int")) == 1)}
    if width is not None:
        rules["width"] = (F.min(F.size("_names")) == width) & (F.max(F.size("_names")) == width)
    require(head, **rules)
    text = {c: F.get("cells", F.array_position("_names", n).cast("int") - 1) for c, n in columns.items()}
    number = lambda t: F.when(finite(t.try_cast("double")), t.try_cast("double"))
    out = raw.where(F.col("row") > header).join(head, "file").select("row", *[(number(t) if c in numbers else t).alias(c) for c, t in text.items()])
    checks = {}
    if rows is not None:
        checks["rows"] = F.count("*") == rows
    if key is not None:
        checks["key"] = (F.count("*") == F.count(key)) & (F.count(key) == F.count_distinct(key))
    if located is not None:
        checks["located"] = F.count_if(F.col(located[0]).isNull() | F.col(located[1]).isNull()) == 0
    return require(out, **checks) if checks else out
