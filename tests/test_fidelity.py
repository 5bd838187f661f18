"""Fidelity checks on small tables, and every builder from the command line to the acceptance sheet."""

import json

import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.operators import fidelity
from tessera.plans import builders
from tessera.sources import reports, store

DATA = "/root/testdata/sf0.001"


def table(spark, rows, kind="r int, c int, v double"):
    return spark.createDataFrame(rows, kind)


def status(df):
    return df.first().status


def test_same_cells(spark):
    a = table(spark, [(0, 0, 1.0), (0, 1, None), (1, 1, 2.0)])
    assert status(fidelity.same_cells(a, table(spark, [(1, 1, 2.0), (0, 0, 1.0)]), "x")) == "pass"
    assert status(fidelity.same_cells(a, table(spark, [(1, 1, 2.5), (0, 0, 1.0)]), "x")) == "FAIL"
    assert status(fidelity.same_cells(a, table(spark, [(0, 0, 1.0)]), "x")) == "FAIL"
    assert status(fidelity.same_cells(table(spark, []), table(spark, []), "x")) == "pass"


def test_integral_and_counts(spark):
    a = table(spark, [(2.0, 1.0), (None, 5.0), (4.0, 0.5)], "v double, w double")
    assert status(fidelity.integral_kept(a, table(spark, [(4.0, 1.0003)], "v double, w double"), "x")) == "pass"
    assert status(fidelity.integral_kept(a, table(spark, [(4.0, 1.1)], "v double, w double"), "x")) == "FAIL"
    assert status(fidelity.integral_kept(table(spark, [], "v double, w double"), a, "x")) == "FAIL"
    n = table(spark, [(0, 0, 3.0), (0, 1, 4.0)])
    assert status(fidelity.counts_kept(n, table(spark, [(0, 0, 7.0)]), "x")) == "pass"
    assert status(fidelity.counts_kept(n, table(spark, [(0, 0, 8.0)]), "x")) == "FAIL"
    assert status(fidelity.counts_kept(n, table(spark, [(0, 0, 8.0), (0, 1, -1.0)]), "x")) == "FAIL"


def test_domains_and_shares(spark):
    a = table(spark, [(0, 0, 1.0), (0, 1, 2.0), (0, 2, 2.0), (0, 3, None)])
    assert status(fidelity.in_codes(a, [1, 2], "x")) == "pass" and status(fidelity.in_codes(a, [1], "x")) == "FAIL"
    assert status(fidelity.in_range(a, 1, 2, "x")) == "pass" and status(fidelity.in_range(a, 1, 1.5, "x")) == "FAIL"
    w = a.withColumn("w", F.lit(1.0))
    assert status(fidelity.share_in(w, F.col("v") == 2, 0.45, 0.55, "x")) == "pass" and status(fidelity.share_in(w, F.col("v") == 2, 0.6, 1, "x")) == "FAIL"
    got = fidelity.share_drift(a, a.where("c < 2"), "x").first()
    assert got.status == "report" and "0.1667" in got.summary
    got = fidelity.quantile_shift(a, a.withColumn("v", F.col("v") + 1), "x", 0.0, 10.0, 0.5).first()
    assert got.status == "report" and got.summary.startswith("q01 1.015 to 2.015, q25 1.375 to 2.375")


def test_level_curves(spark):
    kind = "k double, v double, w double"
    a = table(spark, [(0.0, 1.0, 1.0), (0.0, 3.0, 1.0), (10.0, 5.0, 2.0)], kind)
    assert status(fidelity.level_curves(a, table(spark, [(0.0, 2.0, 1.0), (10.0, 5.0, 1.0)], kind), "x", 1e-9)) == "pass"
    assert status(fidelity.level_curves(a, table(spark, [(0.0, 2.0, 1.0)], kind), "x", 1e-9)) == "FAIL"
    assert status(fidelity.level_curves(a, table(spark, [(0.0, 2.1, 1.0), (10.0, 5.0, 1.0)], kind), "x", 1e-9)) == "FAIL"


def test_integration_sheet(tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "manifest.json").write_text(json.dumps({"layers": [{"id": "a"}, {"id": "b"}]}))
    good = [{"name": "1deg recomputed", "status": "pass", "summary": "x | y"}, {"name": "1deg shares", "status": "report", "summary": ""}]
    folder = str(tmp_path / "r")
    assert reports.write("fidelity-a", good, folder)
    assert "x \\| y" in (tmp_path / "r" / "fidelity-a.md").read_text()
    assert not reports.integrate([], str(tmp_path / "s"), folder)
    reports.write("fidelity-b", good, folder)
    assert reports.integrate([], str(tmp_path / "s"), folder)
    assert not reports.integrate([{"name": "s", "status": "FAIL", "summary": ""}], str(tmp_path / "s"), folder)
    (tmp_path / "r" / "fidelity-b.json").write_text("{")
    assert not reports.integrate([], str(tmp_path / "s"), folder)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("built")
    layers = [f"- {{id: {x}, source: s, native_res: 1deg, home_tier: 1deg, tiers: [1deg], dtype: float32, unit: m, resampling: none, mask: {'validity' if x in ('elevation', 'zone_levels') else 'none'}}}" for x in builders.BUILDERS]
    (folder / "c.yaml").write_text("version: 1\nstatus: draft\nlayers:\n" + "\n".join(layers) + "\n")
    assert cli.main(["build", "--contract", str(folder / "c.yaml"), "--data", DATA, "--store", str(folder / "store")], spark) == 0
    return folder


def test_every_builder_holds(spark, built):
    full, out = str(built / "store"), str(built / "reports")
    assert cli.main(["validate", "--contract", str(built / "c.yaml"), "--store", full], spark) == 0
    assert cli.main(["integrate", "--contract", str(built / "c.yaml"), "--store", full, "--reports", out], spark) == 1
    for layer in builders.BUILDERS:
        assert cli.main(["fidelity", "--data", DATA, "--store", full, "--layer", layer, "--reports", out], spark) == 0, (built / "reports" / f"fidelity-{layer}.md").read_text()
    assert cli.main(["integrate", "--contract", str(built / "c.yaml"), "--store", full, "--reports", out], spark) == 0
    assert cli.main(["fidelity", "--data", DATA, "--store", full, "--layer", "none", "--reports", out], spark) == 2
    assert all(0 < v <= 1 for x in store.read_manifest(full)["layers"] for v in x["coverage"].values())


def test_a_changed_cell_fails(spark, built, tmp_path):
    cells = store.read_layer(spark, str(built / "store"), "line_distance", "1deg")
    off = cells.withColumn("v", F.when((F.col("r") == 0) & (F.col("c") == 0), F.col("v") + 1).otherwise(F.col("v")))
    got = {x.name: x.status for x in builders.checks(spark, "line_distance", DATA, {"1deg": off}).collect()}
    assert got == {"1deg recomputed": "FAIL", "1deg sampled distances": "FAIL", "1deg range": "pass"}
