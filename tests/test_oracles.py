"""Every registered query against its DuckDB oracle at the smallest scale factor (the driver does the same
at sf0.01), plus the entry point's smoke check."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from phenolith.plans.registry import ORACLES, QUERIES  # noqa: E402
from conftest import SF_SMALL

TABLES = ("customer", "orders", "lineitem", "part", "events")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)  # those of the corpus operators have tests of their own
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    ids = {n.split("_")[0] for n in QUERIES}
    for op in ("l1", "l3", "l4", "l5", "l6", "l7", "l8", *(f"x{i}" for i in range(1, 21)),
               *(f"e{i}" for i in range(1, 9)), *(f"f{i}" for i in range(1, 12)),
               "d1", "d2", "d3", "d4", "d5", "d6", *(f"r{i}" for i in range(1, 7))):
        assert op in ids, op


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    want = Counter(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["eid", "phenotype", "field_id", "field_id_label", "eventdate"]
    assert df.count() > 0
