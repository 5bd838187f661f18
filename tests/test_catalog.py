"""Every registered query against its oracle SQL."""

import math

import duckdb
import pytest

from tessera.plans import catalog
from tessera.plans import contracts as _contracts  # noqa: F401 - registers its queries in the catalog
from tessera.plans import layers as _layers  # noqa: F401 - registers its queries in the catalog
from tessera.plans import spatial as _spatial  # noqa: F401 - registers its queries in the catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    clean = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else float(v) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(map(clean, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_without_llm():
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_reconcile_whole_tables(spark):
    a, b = ({r[0] for r in spark.read.parquet(f"{DATA}/{t}.parquet").select(c).collect()} for t, c in (("customer", "c_custkey"), ("events", "user_id")))
    got = {(r.k, r.side) for r in catalog.QUERIES["set_reconcile_keys"](spark, DATA).collect()}
    assert got == {(k, "left") for k in a - b} | {(k, "right") for k in b - a} and got


def same_as_sql(spark, path, name, **tables):
    """A query against its SQL on a few rows of its own; tables: rows as SQL by table."""
    con = duckdb.connect()
    for table, sql in tables.items():
        con.sql(f"copy ({sql}) to '{path}/{table}.parquet' (format parquet)")
        con.sql(f"create view {table} as select * from '{path}/{table}.parquet'")
    got, want = catalog.QUERIES[name](spark, str(path)).toPandas(), con.sql(catalog.ORACLE_SQL[name]).df()
    assert len(want) and rows(got) == rows(want)


def test_density_at_the_pole(spark, tmp_path):
    """Points at 90 degrees, which the offset moves beyond the pole, are in the last row."""
    pole = next(k for k in range(180001) if k * 7919 % 180001 == 180000)
    same_as_sql(spark, tmp_path, "density_pyramid", events=f"select range + {pole - 2} as event_id, 7::bigint as user_id, 'a' as event_type, timestamp '2020-01-01' as ts, 1.0::double as value from range(5)")


CUSTOMERS = "select key::bigint as c_custkey, 1.0::double as c_acctbal from (values {}) t(key)"
SUPPLIERS = "select key::bigint as s_suppkey, 1.0::double as s_acctbal from (values {}) t(key)"


def test_contained_with_a_corner_on_an_edge(spark, tmp_path):
    """The path from a point to its cell's centre turns on an edge."""
    same_as_sql(spark, tmp_path, "contained", customer=CUSTOMERS.format("(56812), (7)"), supplier=SUPPLIERS.format("(2809), (12), (7)"))
