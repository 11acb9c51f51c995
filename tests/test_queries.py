"""Every registered query against its DuckDB oracle on the driver tables
(row count, column names and an order-insensitive value digest), plus the
driver's entry contract."""

from __future__ import annotations

import hashlib
import math

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_module
from linkloom.plans import registry


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def digest(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in data)
    return sorted(columns), len(data), hashlib.sha256("\n".join(lines).encode()).hexdigest()


FAST = [n for n, q in registry.REGISTRY.items() if not n.startswith("stream_")]
STREAMING = [n for n in registry.REGISTRY if n.startswith("stream_")]


def check(spark, duck, name, sf_dir=SF_SMALL):
    q = registry.get(name)
    df = q.run(spark, sf_dir)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    assert got[1] > 0, f"{name} returned no rows"
    if q.sql is not None:
        res = duck(sf_dir).execute(q.sql)
        want = digest([d[0] for d in res.description], res.fetchall())
        assert got == want


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize("name", STREAMING)
def test_stream_query_matches_oracle(spark, duck, name):
    check(spark, duck, name)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql()) <= set(entry_module.oracle_sql())


def test_entry_contract(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["url"]
    assert df.count() > 0
