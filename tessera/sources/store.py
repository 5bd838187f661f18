"""The store: layers as Parquet partitioned by tier and layer, a JSON manifest beside them, and its checks."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.grid import TIERS, dense_grid, shape
from tessera.operators.stats import layer_sha256, present
from tessera.sources.contract import Contract, native_deg
from tessera.sources.copies import copied, files_below

#: What a layer's mask is called after it.
MASK = "__validity"


def write_layer(df: DataFrame, store: str, layer: str, tier: str) -> None:
    """One (tier, layer) partition of the store, replaced as a whole; rows ordered by cell within files for pruning."""
    df.sortWithinPartitions("r", "c").write.mode("overwrite").parquet(f"{store}/tier={tier}/layer={layer}")


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """All layers, lazily; filters on tier and layer prune folders."""
    return spark.read.option("basePath", store).option("mergeSchema", "true").parquet(f"{store}/tier=*/layer=*")


def read_layer(spark: SparkSession, store: str, layer: str, tier: str) -> DataFrame:
    return spark.read.parquet(f"{store}/tier={tier}/layer={layer}")


def write_mask(spark: SparkSession, store: str, layer: str, tier: str, zero_is_missing: bool = False) -> None:
    """The companion of a stored layer: 1 where it has a value, 0 in every other cell of the grid."""
    cells = read_layer(spark, store, layer, tier)
    there = cells.groupBy("r", "c").agg(F.max(present(F.col("v"), zero_is_missing)).alias("p"))
    mask = dense_grid(spark, tier).join(there, ["r", "c"], "left").select("r", "c", F.coalesce("p", F.lit(0)).cast(cells.schema["v"].dataType).alias("v"))
    write_layer(mask, store, f"{layer}{MASK}", tier)


def _level(cells: DataFrame):
    """The level of a cell, 0 in layers without levels."""
    return F.coalesce("k", F.lit(0.0)) if "k" in cells.columns else F.lit(0.0)


def coverage(cells: DataFrame, zero_is_missing: bool = False) -> DataFrame:
    """(tier, layer, coverage): present cells over the grid's cells."""
    size = F.create_map(*[F.lit(x) for t in TIERS for x in (t, shape(t)[0] * shape(t)[1])])
    return cells.groupBy("tier", "layer").agg(F.sum(present(F.col("v"), zero_is_missing)).alias("n"), F.count_distinct(_level(cells)).alias("levels")).select("tier", "layer", (F.col("n") / F.col("levels") / size[F.col("tier")]).alias("coverage"))


def manifest(contract: Contract, cover: list[dict], sidecars: list[dict] = ()) -> dict:
    """Registry of what was built: canonical fields with coverage by tier; no clock, so two builds agree."""
    by: dict[str, dict] = {}
    for row in cover:
        by.setdefault(row["layer"], {})[row["tier"]] = round(row["coverage"], 9)
    layers = [{"id": x.id, "source": x.source, "native_res": x.native_res, "home_tier": x.home_tier, "tiers": list(x.tiers), "dtype": x.dtype, "unit": x.unit, "resampling": x.resampling, "mask": x.mask, "dims": list(x.dims), "visibility": x.visibility, "coverage": by[x.id]} for x in contract.layers if x.id in by]
    return {"crs": "EPSG:4326", "grids": {t: {"deg": str(f), "shape": list(shape(t))} for t, f in TIERS.items()}, "contract": contract.version, "layers": layers, "sidecars": list(sidecars)}


def write_manifest(data: dict, store: str) -> None:
    Path(store, "manifest.json").write_text(json.dumps(data, indent=1, sort_keys=True))


def read_manifest(store: str) -> dict:
    return json.loads(Path(store, "manifest.json").read_text())


#: Fields of a contract that the manifest repeats.
FIELDS = ("dims", "dtype", "unit", "tiers", "home_tier", "visibility", "resampling", "native_res", "mask")


def manifest_checks(data: dict, contract: Contract) -> list[tuple[str, str, str]]:
    """(name, status, summary): manifest and contract have the same layers, the same fields of each, and a coverage for just its tiers; no tier is finer than its source."""
    rule = lambda name, bad: (name, "FAIL" if bad else "pass", ", ".join(map(str, bad)))
    known, told = {x.id: x for x in contract.layers}, {x["id"]: x for x in data["layers"]}
    rows = [rule("layers of the manifest outside the contract", sorted(told.keys() - known.keys())), rule("layers of the contract missing in the manifest", sorted(known.keys() - told.keys()))]
    rows.append(rule("layers twice in the manifest", sorted({x["id"] for x in data["layers"] if sum(y["id"] == x["id"] for y in data["layers"]) > 1})))
    rows.append(rule("coordinates", [] if data.get("crs") == "EPSG:4326" else [data.get("crs")]))
    same = lambda v: list(v) if isinstance(v, tuple) else v
    for name in sorted(told.keys() & known.keys()):
        x, y = told[name], known[name]
        rows.append(rule(f"{name} fields", [f for f in FIELDS if x.get(f) != same(getattr(y, f))]))
        rows.append(rule(f"{name} at 1deg", [] if "1deg" in x["coverage"] else ["missing"]))
        odd = sorted(set(x["coverage"]) ^ set(y.tiers))
        rows.append(rule(f"{name} coverage", odd + [t for t, v in x["coverage"].items() if not isinstance(v, (int, float)) or not 0 <= v <= 1]))
        native = native_deg(y.native_res)
        rows.append(rule(f"{name} finer than its source", [t for t in x["tiers"] if native is not None and t in TIERS and TIERS[t] < native]))
    return rows


def checks(spark: SparkSession, store: str, contract: Contract) -> DataFrame:
    """(name, status, summary) of the structural rules; only FAIL counts against a store."""
    cells, data = read_store(spark, store), read_manifest(store)
    known = {x.id: x for x in contract.layers}
    rows = manifest_checks(data, contract)
    limits = F.create_map(*[x for t in TIERS for x in (F.lit(t), F.struct(F.lit(shape(t)[0]).alias("nlat"), F.lit(shape(t)[1]).alias("nlon")))])
    at = limits[F.col("tier")]
    found = cells.groupBy("tier", "layer").agg(
        F.count("*").alias("n"),
        F.count_distinct(_level(cells), "r", "c").alias("cells"),
        F.count_if(~(F.col("r").between(0, at.nlat - 1) & F.col("c").between(0, at.nlon - 1))).alias("outside"),
    )
    shown = found.select(F.concat_ws(" ", "layer", "tier", F.lit("cells")).alias("name"), F.when((F.col("n") == F.col("cells")) & (F.col("outside") == 0), "pass").otherwise("FAIL").alias("status"), F.concat_ws("/", "n", "cells", "outside").alias("summary"))
    out = spark.createDataFrame(rows, "name string, status string, summary string").union(shown)
    if masked := [x["id"] for x in data["layers"] if known.get(x["id"]) and known[x["id"]].needs_mask]:
        # a mask says 1 just where its layer has a value
        value = cells.where(F.col("layer").isin(masked)).groupBy("tier", "layer", "r", "c").agg(F.max(present(F.col("v"))).alias("p"))
        mask = cells.where(F.col("layer").isin([x + MASK for x in masked])).select("tier", F.expr(f"substr(layer, 1, length(layer) - {len(MASK)})").alias("layer"), "r", "c", F.col("v").alias("m"))
        wrong = value.join(mask, ["tier", "layer", "r", "c"], "full").groupBy("tier", "layer").agg(F.count_if(F.coalesce("p", F.lit(0)) != F.coalesce("m", F.lit(-1.0))).alias("wrong"))
        out = out.union(wrong.select(F.concat_ws(" ", "layer", "tier", F.lit("mask")), F.when(F.col("wrong") == 0, "pass").otherwise("FAIL"), F.col("wrong").cast("string")))
    return out


def checksums(spark: SparkSession, store: str) -> DataFrame:
    """(tier, layer, cells, checksum): SHA-256 of each layer's cells in order; equal stores give equal rows, however their files are cut."""
    cells = read_store(spark, store)
    sizes = cells.groupBy("tier", "layer").agg(F.count("*").alias("cells"))
    return sizes.join(layer_sha256(cells, ["tier", "layer"], "v"), ["tier", "layer"]).select("tier", "layer", "cells", F.col("sha256").alias("checksum"))


def strip_plan(layers: DataFrame, licences: DataFrame) -> DataFrame:
    """(id, keep, reason): internal layers go; pending and confirmed sources stay, rejected and silently expired ones go."""
    gone = F.col("status").isin("rejected", "silent_expired")
    out = layers.join(licences, "source", "left")
    return out.select("id", ((F.col("visibility") == "public") & ~F.coalesce(gone, F.lit(False))).alias("keep"), F.when(F.col("visibility") != "public", "internal").when(gone, F.col("status")).otherwise("kept").alias("reason"))


def export_public(spark: SparkSession, store: str, keep: list[str], out: str) -> None:
    """The kept layers, their masks and the filtered manifest; the two stores must not contain one another.

    Files are copied as they are, by tasks; no row is written anew.
    """
    a, b = Path(store).resolve(), Path(out).resolve()
    if a == b or a in b.parents or b in a.parents:
        raise ValueError(f"{out} overlaps {store}")
    wanted = [*keep, *[x + MASK for x in keep]]
    if b.exists():
        raise ValueError(f"{out} exists")
    files = files_below(spark, store).where(F.regexp_extract("inner", r"^tier=[^/]+/layer=([^/]+)/[^/]+$", 1).isin(wanted))
    copied(files, str(b))
    data = read_manifest(store)
    write_manifest(data | {"layers": [x for x in data["layers"] if x["id"] in keep]}, out)
