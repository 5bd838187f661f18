"""Registered queries of the layer builders, their fidelity checks and the contract's rules, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import fidelity
from tessera.plans import adapters as ad
from tessera.plans import builders
from tessera.plans.catalog import query, r6
from tessera.sources import contract as contracts
from tessera.sources import store

#: What a supplier's layer says: the entry at its key modulo the list's length.
SAYS = {
    "source": ["a", "b", "c"],
    "native_res": ["3min", "0.5deg", "6min (nodes)", "1deg"],
    "home_tier": ["3min", "1deg", "30min", "per-tier", "6min"],
    "tiers": [["1deg", "3min"], ["1deg", "6min"], ["30min", "30min"], ["1deg", "2deg"], ["1deg"], ["1deg", "30min", "6min"]],
    "dtype": ["float32", "float64", "uint8", "uint32", "float32"],
    "resampling": ["mode (ties low)", "mode", "sum", "nearest", "none", "conservative_area_weighted", "mode"],
    "dims": [["lat", "lon"], ["lon", "lat"], ["depth", "lat", "lon"]],
    "visibility": ["public", "public", "secret", "internal"],
}
LICENCES = (("a", "confirmed"), ("b", "silent_expired"))

_LIST = lambda xs: "[" + ", ".join(_LIST(x) if isinstance(x, list) else repr(x) for x in xs) + "]"
_SAYS_SQL = {k: [float(contracts.native_deg(x)) for x in v] if k == "native_res" else [x.split(" (")[0] for x in v] if k == "resampling" else v for k, v in SAYS.items()}
_LAYERS_SQL = "(SELECT concat('layer', s_suppkey % 87) AS id, " + ", ".join(f"{_LIST(v)}[CAST(s_suppkey % {len(v)} AS INT) + 1] AS {dict(native_res='native', home_tier='home').get(k, k)}" for k, v in _SAYS_SQL.items()) + " FROM supplier) AS l"
_DEG = "MAP {'1deg': 1.0::DOUBLE, '30min': 0.5::DOUBLE, '6min': 0.1::DOUBLE, '3min': 0.05::DOUBLE, '30sec': 1.0::DOUBLE / 120}"
_RULES = {
    "unknown tier": f"len(list_filter(tiers, lambda t: NOT list_contains(map_keys({_DEG}), t))) > 0",
    "1deg is missing": "NOT list_contains(tiers, '1deg')",
    "tier twice": "len(list_distinct(tiers)) < len(tiers)",
    "home tier is none of the tiers": "NOT list_contains(tiers, home) AND home <> 'per-tier'",
    "tier finer than the source": f"len(list_filter(tiers, lambda t: coalesce({_DEG}[t] < native - 1e-12, false))) > 0",
    "unknown dtype": f"NOT list_contains({_LIST(contracts.DTYPES)}, dtype)",
    "unknown resampling": f"NOT list_contains({_LIST(contracts.RESAMPLING)}, resampling)",
    "unknown visibility": "visibility NOT IN ('public', 'internal')",
    "dims": "NOT (dims[-2] = 'lat' AND dims[-1] = 'lon')",
}


def _layers(spark, sf_dir):
    """A contract's rows made from the suppliers, most of them with a fault or more."""
    n = F.col("s_suppkey")
    lit = lambda x: F.array(*map(F.lit, x)) if isinstance(x, list) else F.lit(x)
    said = [F.get(F.array(*map(lit, v)), (n % len(v)).cast("int")).alias(k) for k, v in SAYS.items()]
    return ad.read(spark, sf_dir, "supplier").select(F.concat(F.lit("layer"), (n % 87).cast("string")).alias("id"), *said)


@query(" UNION ALL ".join(f"SELECT id, '{rule}' AS rule FROM {_LAYERS_SQL} WHERE {test}" for rule, test in _RULES.items()) + f" UNION ALL SELECT id, 'id twice' AS rule FROM {_LAYERS_SQL} GROUP BY id HAVING count(*) > 1")
def contract_violations(spark, sf_dir):
    return contracts.violations(_layers(spark, sf_dir))


@query(f"SELECT id, 'tier finer than the source' AS rule, t AS tier FROM (SELECT id, native, unnest(tiers) AS t FROM {_LAYERS_SQL}) WHERE {_DEG}[t] < native - 1e-12")
def iron_rule(spark, sf_dir):
    from tessera.functions.grid import TIERS
    from tessera.functions.text import resolution_deg

    degrees = F.create_map(*[F.lit(x) for t, f in TIERS.items() for x in (t, float(f))])
    each = _layers(spark, sf_dir).select("id", "native_res", F.explode("tiers").alias("tier"))
    return each.where(F.try_element_at(degrees, F.col("tier")) < resolution_deg(F.col("native_res")) - 1e-12).select("id", F.lit("tier finer than the source").alias("rule"), "tier")


@query(f"""SELECT id, visibility = 'public' AND coalesce(status, '') NOT IN ('rejected', 'silent_expired') AS keep,
  CASE WHEN visibility <> 'public' THEN 'internal' WHEN status IN ('rejected', 'silent_expired') THEN status ELSE 'kept' END AS reason
  FROM {_LAYERS_SQL} LEFT JOIN (VALUES {", ".join(map(str, LICENCES))}) AS s(source, status) ON l.source = s.source""")
def strip_plan(spark, sf_dir):
    return store.strip_plan(_layers(spark, sf_dir), spark.createDataFrame(list(LICENCES), "source string, status string"))


@query(f"""SELECT '1deg counts' AS name, CASE WHEN a = b AND low >= 0 THEN 'pass' ELSE 'FAIL' END AS status, concat(a, ' to ', b) AS summary
  FROM (SELECT count(*) AS a FROM events), (SELECT CAST(sum(n) AS BIGINT) AS b, min(n) AS low FROM (SELECT count(*) AS n FROM ({ad.POINTS_SQL}) GROUP BY floor(lat + 90), floor(lon + 180)))""")
def count_conservation(spark, sf_dir):
    fine = ad.points(spark, sf_dir).select(F.lit(1).alias("v"))
    return fidelity.counts_kept(fine, builders.point_density(spark, sf_dir, "1deg"), "1deg counts")


@query(f"""WITH x AS (SELECT v AS a, CASE WHEN v % 11 <> 0 THEN CASE WHEN v % 13 = 0 THEN v + 1 ELSE v END END AS b FROM ({ad.RASTER_SQL}))
  SELECT 'raster' AS name, 'FAIL' AS status, concat(count(*), ' cells, ', sum(CASE WHEN b IS NULL OR a <> b THEN 1 ELSE 0 END), ' differ, ', sum(CASE WHEN b IS NULL THEN 1 ELSE 0 END), ' of them only missing on one side') AS summary FROM x""")
def recompute_differences(spark, sf_dir):
    """The raster against a copy with holes and changed cells."""
    x, v = ad.raster(spark, sf_dir), F.col("v")
    return fidelity.same_cells(x, x.withColumn("v", F.when(v % 11 != 0, F.when(v % 13 == 0, v + 1).otherwise(v))), "raster")


_W5 = "(sin(radians((r + 1) * 5 - 90.0::DOUBLE)) - sin(radians(r * 5 - 90.0::DOUBLE)))"


@query(f"SELECT CAST(zone AS DOUBLE) AS k, round(sum(dep * {_W5}) / sum({_W5}), 3) AS source, round(sum(dep * {_W5}) / sum({_W5}), 3) AS built FROM ({ad.ZONES_SQL}) GROUP BY 1")
def level_curves(spark, sf_dir):
    """Each level's weighted mean, from the source and from the built layer at 1 degree."""
    mean = lambda x, s: x.groupBy("k").agg(F.round(F.sum(F.col("v") * F.col("w")) / F.sum("w"), 3).alias(s))
    source = builders.source_weights(builders.levels_source(spark, sf_dir))
    return mean(source, "source").join(mean(fidelity.area_weighted(builders.zone_levels(spark, sf_dir, "1deg"), "1deg"), "built"), "k")


@query(f"""SELECT CAST(r * 5 + i AS INT) AS r, CAST(c * 5 + j AS INT) AS c, dip * 25.0::DOUBLE AS v
  FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY dep, zone) AS k FROM ({ad.ZONES_SQL})) CROSS JOIN (SELECT CAST(range AS INT) AS i FROM range(5)) CROSS JOIN (SELECT CAST(range AS INT) AS j FROM range(5)) WHERE k = 1""")
def strike_layer(spark, sf_dir):
    return builders.slab_strike(spark, sf_dir, "1deg").select("r", "c", r6(F.col("v")).alias("v"))


@query(f"""WITH h AS (SELECT CAST(least(floor((lat + 90) * 2), 359) AS INT) AS r, CAST(least(floor((((lon + 180) - 180) + 180) * 2), 719) AS INT) AS c, CAST(id % 7 + 1 AS INT) AS v, q, id FROM ({ad.PRIMARY_SQL})),
  w AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY q, id DESC) AS k FROM h),
  n AS (SELECT CAST(r // 2 AS INT) AS r, CAST(c // 2 AS INT) AS c, v, count(*) AS n FROM w WHERE k = 1 GROUP BY 1, 2, 3)
  SELECT r, c, CAST(v AS DOUBLE) AS v FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY n DESC, v) AS k FROM n) WHERE k = 1""")
def class_layer(spark, sf_dir):
    return builders.site_class(spark, sf_dir, "1deg")


@query(f"SELECT round(sum(CASE WHEN v > 100 THEN {_W5} ELSE 0 END) / 144, 6) AS share FROM ({ad.RASTER_SQL})")
def land_share(spark, sf_dir):
    """Share of the globe's area that the land mask covers."""
    cells = fidelity.area_weighted(builders.land_mask(spark, sf_dir, "1deg"), "1deg")
    return cells.agg(r6(F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("share"))


@query()
def distance_sample(spark, sf_dir):
    """An evenly spaced sample of the distance layer against every segment."""
    return fidelity.distances_hold(builders.line_distance(spark, sf_dir, "1deg"), builders.line_source(spark, sf_dir), "1deg sampled distances", "1deg")
