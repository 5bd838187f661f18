"""Line and record numbers of files read in many splits."""

import csv
import io

import pytest
from pyspark.sql import functions as F

from tessera.sources import ordinals, tables
from tessera.sources.readers import SourceMismatch


@pytest.fixture
def split(spark):
    """Files are cut every few hundred bytes."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("stretch", [900, ordinals.STRETCH])
def test_lines(spark, split, tmp_path, monkeypatch, stretch):
    monkeypatch.setattr(ordinals.prefix_sum, "__defaults__", (stretch,))
    texts = {"a.txt": [f"line {i} " + "x" * (i % 90) for i in range(400)], "b.txt": [""] * 300 + ["end"], "c.txt": [], "d.txt": ["only"]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(x + ("\r\n" if name == "a.txt" else "\n") for x in lines))
    found = ordinals.numbered(spark, str(tmp_path))
    assert ordinals._lines(spark, str(tmp_path / "a.txt")).select("at").distinct().count() >= 20
    got = sorted((r.path.rsplit("/", 1)[-1], r.line, r.value) for r in found.collect())
    assert got == [(n, i + 1, x) for n, lines in sorted(texts.items()) for i, x in enumerate(lines)]
    over = sorted((r.line, r.value) for r in ordinals.numbered(spark, str(tmp_path), across=True).collect())
    assert over == list(enumerate((x for _, lines in sorted(texts.items()) for x in lines), 1))


def test_records(spark, split, tmp_path):
    """Quoted fields over many lines and splits, doubled quotes, empty lines between and inside records."""
    rows = [[str(i), ("note\n\n" * (i % 40) + ' said ""x""') if i % 3 else "", "NA" if i % 5 == 0 else f"{i}.5"] for i in range(300)]
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(["id", "note", "q"])
    for i, r in enumerate(rows):
        w.writerow(r)
        if i % 50 == 0:
            out.write("\n\n")
    (tmp_path / "t.csv").write_text(out.getvalue())
    got = tables.csv_table(spark, str(tmp_path / "t.csv"), ["id", "note", "q"], numbers=("id",), ordinal="source_row").orderBy("source_row").collect()
    assert [(r.source_row, int(r.id), r.note, r.q) for r in got] == [(i + 1, i, r[1] or None, r[2]) for i, r in enumerate(rows)]
    (tmp_path / "open.csv").write_text('id,note,q\n1,"never closed,2\n')
    with pytest.raises(SourceMismatch, match="quotes"):
        ordinals.records(spark, str(tmp_path / "open.csv"))


def test_evaluated_in_splits(spark, split, tmp_path):
    n = 3000
    (tmp_path / "out.txt").write_text("".join(f"{i % 7} {i % 11} {i % 13} {i * 0.5}\n" for i in range(n)))
    points = spark.range(n).select(F.col("id").alias("i"), *[(F.col("id") % k).cast("double").alias(c) for c, k in (("x", 7), ("y", 11), ("z", 13))])
    got = tables.evaluated(spark, str(tmp_path / "out.txt"), points, ["a", "b", "c", "v"])
    assert got.count() == n and got.where(F.col("v") != F.col("i") * 0.5).count() == 0
    with pytest.raises(SourceMismatch):
        tables.evaluated(spark, str(tmp_path / "out.txt"), points.where("i > 0").withColumn("i", F.col("i") - 1), ["a", "b", "c", "v"])


def strain_lines(nlat=12, nlon=20, trailing=7):
    body = [f"{-1.25 + 0.1 * (k // nlon):.4f} {-179.95 + 0.1 * (k % nlon):.4f} {k} {k * 2} {-k} {k / 4} 9 9" for k in range(nlat * nlon)]
    return ["header"] * 25 + body + [f"{-1.21 + 0.1 * k:.3f} {-179.93 + 0.1 * k:.3f} 1 1 1 1 9 9" for k in range(trailing)]


def test_strain_grid(spark, split, tmp_path):
    read = lambda lines, **more: (
        (tmp_path / "s.txt").write_text("\n".join(lines) + "\n"),
        ordinals.strain_grid(spark, str(tmp_path / "s.txt"), 12, 20, -1.25, -179.95, 0.1, ["exx", "eyy", "exy", "vorticity"], 25, **more),
    )[1]
    good = strain_lines()
    got = {(r.r, r.c): r.vorticity for r in read(good, trailing=7).collect()}
    assert got == {(k // 20, k % 20): k / 4 for k in range(240)}
    swapped = [*good[:30], good[31], good[30], *good[32:]]
    bad = {
        "rows": (good[:-1], {"trailing": 7}),
        "row major": (swapped, {}),
        "trailing": ([*good, "-1.25 50.0 1 1 1 1"], {}),
        "values": ([*good[:40], good[40].rsplit(" ", 3)[0].rsplit(" ", 1)[0] + " nan 9 9", *good[41:]], {}),
    }
    for rule, (lines, more) in bad.items():
        with pytest.raises(SourceMismatch, match=rule):
            read(lines, **more)
