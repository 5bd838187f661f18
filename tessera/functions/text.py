"""Scalar parsing and code tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def thickness_m(text: Column) -> Column:
    """Mean over comma-separated segments: a range's middle, a bound or a value, feet as 0.3048 m; null if none parses."""
    number = r"(\d+(?:\.\d+)?)"

    def value(s):
        low = F.regexp_extract(s, rf"{number}\s*-\s*{number}", 1)
        high = F.regexp_extract(s, rf"{number}\s*-\s*{number}", 2)
        one = F.regexp_extract(s, number, 1)
        metres = F.when(low != "", (low.try_cast("double") + high.try_cast("double")) / 2).when(one != "", one.try_cast("double"))
        return metres * F.when(s.rlike(r"\d\s*(ft|feet|foot)"), 0.3048).otherwise(1.0)

    found = F.filter(F.transform(F.split(F.lower(text), ","), value), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, F.aggregate(found, F.lit(0.0), lambda a, x: a + x) / F.size(found))


def thickness_class(metres: Column) -> Column:
    """Right-closed bins 2, 10, 50, 200 m as 1 to 5; 0 where there is no thickness."""
    out = F.when(metres.isNull(), 0)
    for code, edge in enumerate((2, 10, 50, 200), 1):
        out = out.when(metres <= edge, code)
    return out.otherwise(5).cast("int")


def encoding(df: DataFrame, label: str) -> DataFrame:
    """(label, code): labels in lexicographic order as 1..n. Labels are a code table's worth, whatever the rows."""
    return df.select(label).where(F.col(label).isNotNull()).distinct().withColumn("code", F.row_number().over(Window.orderBy(label)))


def strip_note(text: Column) -> Column:
    """What stands before the first bracket, plain or full-width."""
    return F.trim(F.split(text, "[（(]")[0])


def resolution_deg(text: Column) -> Column:
    """Degrees of ``N deg|min|sec``."""
    n = F.regexp_extract(text, r"([0-9.]+)\s*(deg|min|sec)", 1).try_cast("double")
    unit = F.regexp_extract(text, r"([0-9.]+)\s*(deg|min|sec)", 2)
    return F.when(unit == "deg", n).when(unit == "min", n / 60).when(unit == "sec", n / 3600)
