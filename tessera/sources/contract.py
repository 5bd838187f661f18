"""The layer contract: YAML to typed records, and its rules as one query of violations."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.grid import TIERS

# fixed values: what a contract may say
DTYPES = ("float32", "uint8", "uint32")
RESAMPLING = ("conservative_area_weighted", "mode", "sum", "none", "circular_axial", "circular", "exact_formula")
DIMS = ("lat", "lon", "depth", "time")
REQUIRED = ("id", "source", "native_res", "home_tier", "tiers", "dtype", "unit", "resampling", "mask")
#: Home tiers of layers that have none of their own, and native resolutions that bound no tier.
PER_TIER = ("逐档", "per-tier")
UNBOUND = ("point", "vector-line", "vector-polygon", "exact")


class ContractViolation(ValueError):
    """A contract that cannot be read or breaks a rule."""


@dataclass(frozen=True)
class Layer:
    id: str
    source: str
    native_res: str
    home_tier: str
    tiers: tuple[str, ...]
    dtype: str
    unit: str
    resampling: str
    mask: str
    dims: tuple[str, ...] = ("lat", "lon")
    visibility: str = "internal"
    notes: str = ""

    @property
    def needs_mask(self) -> bool:
        return "validity" in self.mask


@dataclass(frozen=True)
class Contract:
    version: str
    status: str
    layers: tuple[Layer, ...] = field(default_factory=tuple)


def load_contract(path: str) -> Contract:
    import yaml

    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f)
    layers = []
    for entry in raw.get("layers") or ():
        if missing := [k for k in REQUIRED if entry.get(k) in (None, "")]:
            raise ContractViolation(f"{entry.get('id', '?')}: no {', '.join(missing)}")
        known = {k: entry[k] for k in Layer.__dataclass_fields__ if k in entry}
        known["tiers"], known["dims"] = tuple(entry["tiers"]), tuple(entry.get("dims", ("lat", "lon")))
        layers.append(Layer(**known))
    return Contract(str(raw.get("version", "")), str(raw.get("status", "")), tuple(layers))


def frame(spark: SparkSession, contract: Contract) -> DataFrame:
    """A row for each layer."""
    kind = "id string, source string, native_res string, home_tier string, tiers array<string>, dtype string, unit string, resampling string, mask string, dims array<string>, visibility string, notes string"
    return spark.createDataFrame([tuple(list(v) if isinstance(v, tuple) else str(v) for v in asdict(x).values()) for x in contract.layers], kind)


def violations(layers: DataFrame) -> DataFrame:
    """(id, rule) of every broken rule: legal tokens, tiers, no tier finer than the source, unique ids."""
    from tessera.functions.text import resolution_deg, strip_note

    names = F.array(*[F.lit(t) for t in TIERS])
    degrees = F.create_map(*[F.lit(x) for t, f in TIERS.items() for x in (t, float(f))])
    native = resolution_deg(F.col("native_res"))
    rules = {
        "unknown tier": F.size(F.array_except("tiers", names)) > 0,
        "1deg is missing": ~F.array_contains("tiers", "1deg"),
        "tier twice": F.size(F.array_distinct("tiers")) < F.size("tiers"),
        "home tier is none of the tiers": ~F.array_contains("tiers", F.col("home_tier")) & ~F.col("home_tier").isin(*PER_TIER),
        "tier finer than the source": F.exists("tiers", lambda t: F.coalesce(F.try_element_at(degrees, t) < native - 1e-12, F.lit(False))),
        "native resolution": ~F.trim(strip_note(F.col("native_res"))).rlike(r"^\d+(\.\d+)?\s*(deg|min|sec)$") & ~F.trim(strip_note(F.col("native_res"))).isin(*UNBOUND),
        "unknown dtype": ~F.col("dtype").isin(*DTYPES),
        "unknown resampling": ~strip_note(F.col("resampling")).isin(*RESAMPLING),
        "unknown visibility": ~F.col("visibility").isin("public", "internal"),
        "dims": (F.size(F.array_except("dims", F.array(*[F.lit(d) for d in DIMS]))) > 0) | (F.array_join(F.slice("dims", -2, 2), ",") != "lat,lon"),
    }
    broken = F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()])
    found = layers.select("id", F.explode(F.array_compact(broken)).alias("rule"))
    twice = layers.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("id twice").alias("rule"))
    return found.union(twice)


def exact_deg(text: str) -> Fraction:
    """A tier's or a native resolution's degrees, exactly."""
    if text in TIERS:
        return TIERS[text]
    number = text.rstrip("degmins ")
    unit = text[len(number) :].strip()
    return Fraction(number) / {"deg": 1, "min": 60, "sec": 3600}[unit]


def native_deg(text: str) -> Fraction | None:
    """A native resolution's degrees, a note behind it left out; None where it bounds no tier."""
    import re

    bare = re.split(r"[（(]", text)[0].strip()
    if bare in UNBOUND:
        return None
    m = re.fullmatch(r"(\d+(?:\.\d+)?)\s*(deg|min|sec)", bare)
    if not m:
        raise ContractViolation(f"native resolution {text!r}")
    return Fraction(m[1]) / {"deg": 1, "min": 60, "sec": 3600}[m[2]]
