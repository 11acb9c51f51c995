"""Ledger, pending files (JN1), download plan (LIM1), ledger set (SET3),
dedup (AGG1) and the size-checked broadcast."""

from __future__ import annotations

import os

import pytest
from conftest import rows

from linkloom.operators.dedup import dedup_stable, dedup_urls, distinct_urls, new_urls_only
from linkloom.operators.joins import anti_join
from linkloom.operators.ledger import (download_plan, mark_processed, merge_ledger, pending_files,
                                       read_ledger)
from linkloom.tables import LinkTable


def names(spark, values, col="file_name"):
    return spark.createDataFrame([(v,) for v in values], f"{col} string")


def test_missing_ledger_is_empty_and_marking_twice_is_harmless(spark, work):
    ledger = LinkTable(os.path.join(work, "ledger"))
    assert read_ledger(spark, ledger).count() == 0
    mark_processed(names(spark, ["a", "b", "a"]), ledger)
    mark_processed(names(spark, ["b"]), ledger)
    assert rows(read_ledger(spark, ledger).distinct()) == [("a",), ("b",)]


def test_merge_ledger_is_a_set(spark):
    merged = merge_ledger(names(spark, ["a", "b"]), names(spark, ["b", "c"], "n"), column="n")
    assert rows(merged) == [("a",), ("b",), ("c",)]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_pending_files_broadcast_or_shuffle_same_rows(spark, threshold):
    files = spark.createDataFrame([("/w/a.gz", "a.gz"), ("/w/b.gz", "b.gz"), ("/v/c.gz", "c.gz")],
                                  "path string, file_name string")
    ledger = names(spark, ["b.gz", "zz"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = pending_files(files, ledger)
        assert rows(out, "file_name") == [("a.gz",), ("c.gz",)]
        assert "hint" not in out._jdf.queryExecution().logical().toString().lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_anti_join_on_names(spark):
    left = names(spark, ["a", "b", "c"])
    assert rows(anti_join(left, names(spark, ["b"]), "file_name")) == [("a",), ("c",)]


def test_download_plan_rules(spark):
    urls = spark.createDataFrame([(u,) for u in [
        "https://h/p/3.gz", "https://h/p/1.gz", "https://h/q/1.gz",  # name 1.gz twice
        "https://h/p/2.gz", "", "https://h/p/", "https://h/p/4.gz", "https://h/p/5.gz",
    ]], "value string")
    ledger = names(spark, ["2.gz"])
    plan = download_plan(urls, ledger, 3)
    assert [tuple(r) for r in plan.collect()] == [
        ("1.gz", "https://h/p/1.gz"), ("3.gz", "https://h/p/3.gz"), ("4.gz", "https://h/p/4.gz")]
    assert download_plan(urls, ledger, 0).count() == 0
    assert download_plan(urls, ledger, 100).count() == 4
    with pytest.raises(ValueError):
        download_plan(urls, ledger, -1)


def links(spark):
    data = [(1, "a", "u1"), (2, "b", "u1"), (3, "c", None), (0, "d", None), (5, "e", "u2")]
    return spark.createDataFrame(data, "k int, text string, url string")


def test_dedup_forms(spark):
    df = links(spark)
    assert dedup_urls(df).count() == 3  # null url is one group
    stable = dedup_stable(df, ["k"])
    assert stable.columns == ["k", "text", "url"]
    assert rows(stable) == sorted([(1, "a", "u1"), (0, "d", None), (5, "e", "u2")], key=repr)
    assert rows(distinct_urls(df)) == sorted([("u1",), (None,), ("u2",)], key=repr)


def test_dedup_hot_key_is_combined_before_the_shuffle(spark):
    plan = dedup_stable(links(spark), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_new_urls_only_matches_null_too(spark):
    df = links(spark)
    existing = spark.createDataFrame([("u1",), (None,)], "url string")
    assert rows(new_urls_only(df, existing), "url") == [("u2",)]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

NAMES = st.sampled_from(["a.gz", "b.gz", "c.gz", "d.gz", "", "x?y=1"])
DIRS = st.sampled_from(["https://h/p/", "https://h/q/", "//h/", "h/", ""])


def model_plan(urls, ledger, n):
    def name(u):
        i = u.rfind("/")
        return u[i + 1:] if 0 <= i < len(u) - 1 else ""
    best = {}
    for u in urls:
        f = name(u)
        if f and f not in ledger:
            best[f] = min(best.get(f, u), u)
    return sorted(((f, u) for f, u in best.items()), key=lambda r: (r[1], r[0]))[:n]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(urls=st.lists(st.tuples(DIRS, NAMES).map("".join), min_size=1, max_size=20),
       ledger=st.sets(NAMES, max_size=3), n=st.integers(0, 6))
def test_property_download_plan_matches_model(spark, urls, ledger, n):
    lines = spark.createDataFrame([(u,) for u in urls], "value string")
    plan = download_plan(lines, names(spark, sorted(ledger)), n)
    assert [tuple(r) for r in plan.collect()] == model_plan(urls, ledger, n)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 50), st.sampled_from(["t1", "t2", None]),
                          st.sampled_from(["u1", "u2", "U1", None])), min_size=1, max_size=25,
                unique_by=lambda r: r[0]))
def test_property_stable_dedup_keeps_smallest_per_url(spark, data):
    df = spark.createDataFrame(data, "k int, text string, url string")
    best = {}
    for row in data:
        if row[2] not in best or row[0] < best[row[2]][0]:
            best[row[2]] = row
    assert rows(dedup_stable(df, ["k"])) == sorted(best.values(), key=repr)
