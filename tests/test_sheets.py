"""xlsx sheets written by hand, and the size of an export."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.sources import packaging, sheets, store
from tessera.sources.readers import SourceMismatch

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
TEXTS = ["ID", "lat", "lon", "q", "name", "rich text", "x & y"]


def book(path, rows, second="<row r='1'><c r='A1'><v>1</v></c></row>"):
    """A workbook with sheets data and other; rows: XML."""
    shared = "".join(f"<si><r><t>rich</t></r><r><t> text</t></r><rPh><t>no</t></rPh></si>" if t == "rich text" else f"<si><t>{t.replace('&', '&amp;')}</t></si>" for t in TEXTS)
    sheet = lambda body: f"<worksheet xmlns='{MAIN}'><sheetData>{body}</sheetData></worksheet>"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f"<workbook xmlns='{MAIN}' xmlns:r='{LINKS}'><sheets><sheet name='data' sheetId='1' r:id='a'/><sheet name='other' sheetId='2' r:id='b'/></sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'><Relationship Id='a' Target='worksheets/one.xml'/><Relationship Id='b' Target='/xl/worksheets/two.xml'/></Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst xmlns='{MAIN}'>{shared}</sst>")
        z.writestr("xl/worksheets/one.xml", sheet(rows))
        z.writestr("xl/worksheets/two.xml", sheet(second))


def line(n, *cells):
    """Cells (column, kind, value); kind s gives a shared text by its content."""
    one = lambda c, k, v: f"<c r='{c}{n}' t='{k}'><v>{TEXTS.index(v) if k == 's' else v}</v></c>" if k != "i" else f"<c r='{c}{n}' t='inlineStr'><is><t>{v}</t></is></c>"
    return f"<row r='{n}'>{''.join(one(*x) for x in cells)}</row>"


HEAD = line(1, ("A", "s", "name")) + line(2, ("A", "s", "ID"), ("B", "s", "lat"), ("C", "s", "lon"), ("AB", "s", "q"), ("D", "s", "name"))
COLUMNS = {"id": "ID", "lat": "lat", "lon": "lon", "q": "q", "name": "name"}
GIVEN = {"columns": COLUMNS, "header": 2, "numbers": ("lat", "lon", "q")}


def test_sheet(spark, tmp_path):
    rows = HEAD + line(3, ("A", "i", "7a"), ("B", "n", "1.5"), ("C", "n", "-2E1"), ("D", "s", "rich text"), ("AB", "n", "60"))
    rows += line(5, ("A", "n", "8"), ("B", "n", "-90"), ("C", "n", "0"), ("D", "s", "x & y"), ("AB", "i", "n/a")) + line(6, ("A", "e", "#N/A")) + "<row r='7'/>"
    book(tmp_path / "a.xlsx", rows)
    got = sheets.sheet_table(spark, str(tmp_path), **GIVEN, key="id", located=("lat", "lon"), rows=2, width=28)
    assert [tuple(x) for x in got.orderBy("row").collect()] == [(3, "7a", 1.5, -20.0, 60.0, "rich text"), (5, "8", -90.0, 0.0, None, "x & y")]
    assert [tuple(x) for x in sheets.sheet_rows(spark, str(tmp_path), "other").select("row", "cells").collect()] == [(1, ["1"])]


@pytest.mark.parametrize(
    "rows, more, what",
    [
        (HEAD + line(3, ("A", "i", "a")) + line(4, ("A", "i", "a")), {"key": "id"}, "key"),
        (HEAD + line(3, ("B", "n", "1")), {"key": "id"}, "key"),
        (HEAD + line(3, ("A", "i", "a"), ("B", "i", "north"), ("C", "n", "1")), {"located": ("lat", "lon")}, "located"),
        (HEAD + line(3, ("A", "i", "a")), {"rows": 2}, "rows"),
        (HEAD, {"width": 27}, "width"),
        (line(2, ("A", "s", "ID"), ("B", "s", "ID"), ("C", "s", "lat"), ("D", "s", "lon"), ("E", "s", "q"), ("F", "s", "name")), {}, "header"),
        (line(2, ("A", "s", "ID")), {}, "header"),
        ("", {}, "header"),
    ],
)
def test_sheet_contract(spark, tmp_path, rows, more, what):
    book(tmp_path / "a.xlsx", rows)
    with pytest.raises(SourceMismatch, match=what):
        sheets.sheet_table(spark, str(tmp_path), **GIVEN, **more)


def test_sheet_without_rows(spark, tmp_path):
    book(tmp_path / "a.xlsx", HEAD)
    assert sheets.sheet_table(spark, str(tmp_path), **GIVEN, rows=0, key="id").count() == 0


def test_columns():
    assert [sheets._column(x) for x in ("A1", "Z9", "AA1", "AB7", "XFD1048576")] == [0, 25, 26, 27, 16383]


def test_many_rows(spark, tmp_path):
    """More rows than one batch."""
    n = 2 * sheets.BATCH_ROWS + 1
    book(tmp_path / "a.xlsx", HEAD + "".join(line(3 + i, ("A", "n", i), ("B", "n", 1), ("C", "n", 2)) for i in range(n)))
    got = sheets.sheet_table(spark, str(tmp_path), **GIVEN, rows=n, key="id")
    assert got.agg(F.sum(F.col("id").cast("long"))).first()[0] == n * (n - 1) // 2


def test_packaging():
    limit = packaging.MAX_BYTES
    assert packaging.packaging(100, limit) == {"files": 100, "bytes": limit, "over_files": False, "over_bytes": False, "form": "files", "parts": 1}
    assert packaging.packaging(101, 5)["form"] == "archive"
    assert packaging.packaging(1, limit + 1)["form"] == "split archive" and packaging.packaging(1, limit + 1)["parts"] == 2
    assert packaging.packaging(0, 0)["parts"] == 1


def test_estimate(spark, tmp_path):
    cells = spark.createDataFrame([(0, 0, 1.0)], "r int, c int, v double").coalesce(1)
    for layer in ("a", "a" + store.MASK, "b"):
        store.write_layer(cells, str(tmp_path), layer, "1deg")
    got = packaging.estimate(spark, str(tmp_path), ["a"])
    assert got["full"][0] == 3 and got["public"][0] == 2 and 0 < got["public"][1] < got["full"][1]
    assert packaging.estimate(spark, str(tmp_path), [])["public"] == (0, 0)


def test_dry_run(spark, tmp_path, capsys):
    """Kept layers are weighed, nothing is written."""
    contract = """
version: 1
status: draft
layers:
- {id: point_density, source: events, native_res: 3min, home_tier: 6min, tiers: [1deg, 6min], dtype: uint32, unit: count, resampling: sum, mask: none, visibility: public}
- {id: later, source: other, native_res: 1deg, home_tier: 1deg, tiers: [1deg], dtype: float32, unit: m, resampling: none, mask: none, visibility: public}
"""
    (tmp_path / "c.yaml").write_text(contract)
    (tmp_path / "l.json").write_text(json.dumps({"source": "other", "status": "rejected"}))
    full, out = tmp_path / "store", tmp_path / "public"
    cells = spark.createDataFrame([(0, 0, 1.0)], "r int, c int, v double").coalesce(1)
    for layer in ("later", "kept_by_none"):
        store.write_layer(cells, str(full), layer, "1deg")
    given = ["export-public", "--contract", str(tmp_path / "c.yaml"), "--store", str(full), "--licences", str(tmp_path / "l.json"), "--out", str(out), "--dry-run"]
    assert cli.main(given, spark) == 0
    got = json.loads(capsys.readouterr().out)
    assert got["plan"]["later"] == "rejected" and got["packaging"]["files"] == 0 and not out.exists()
    (tmp_path / "l.json").write_text(json.dumps({"source": "other", "status": "pending"}))
    assert cli.main(given, spark) == 0
    assert json.loads(capsys.readouterr().out)["packaging"]["files"] == 1 and not out.exists()
