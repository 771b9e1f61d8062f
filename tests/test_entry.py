"""The registered queries against their DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from compare_oracle import TABLES, digest
from driftwood.plans.queries import QUERIES

from .conftest import plan_text

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 39 and df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries()) & set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(exp)
    assert digest(got, cols) == digest(exp, ocols)
    # scale guards on the executed plan: no Python evaluation, no all-pairs join
    plan = plan_text(df)
    assert not [f for f in FORBIDDEN if f in plan]


def test_queries_do_not_share_state(spark):
    """Running a query must not change another one's result (order and
    repetition independence)."""
    from driftwood.schemas import TRAINING_SCHEMA
    before = len(TRAINING_SCHEMA.fields)
    qs = E.queries()
    for name in ("sink_partitioned", "sink_partitioned", "csv_roundtrip"):
        df = qs[name](spark, SF)
        df.count()
    assert len(TRAINING_SCHEMA.fields) == before == 39
    assert len(qs["csv_roundtrip"](spark, SF).columns) == 39


def test_inventory_covered():
    """The map names every operator row of the inventory; that
    the queries do what it says is what the oracle comparison shows."""
    from driftwood.plans.queries import INVENTORY
    rows = ([f"S{i}" for i in range(1, 10)] + [f"K{i}" for i in range(1, 4)]
            + [f"F{i}" for i in range(1, 8)] + [f"P{i}" for i in range(1, 9)]
            + [f"J{i}" for i in range(1, 7)] + [f"A{i}" for i in range(1, 9)]
            + [f"L{i}" for i in range(1, 4)] + [f"U{i}" for i in range(1, 5)]
            + [f"X{i}" for i in range(1, 18)] + [f"G{i}" for i in range(1, 7)])
    covered = {i for ids in INVENTORY.values() for i in ids}
    assert not set(rows) - covered
