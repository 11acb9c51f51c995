"""File-name and WARC -> WAT rewrites (FN3-FN10, S10)."""

from __future__ import annotations

import pytest

from linkloom.functions.names import (WAT_URL_PREFIX, file_name_of_path, file_name_of_url,
                                      is_count_arg, warc_name_to_wat_url, warc_to_wat)

# A golden archive name and the url it must become.
WARC = ("crawl-data/CC-MAIN-2023-14/segments/1679296949642.35/warc/"
        "CC-MAIN-20230331113819-20230331143819-00137.warc.gz")
WAT_URL = (WAT_URL_PREFIX + "crawl-data/CC-MAIN-2023-14/segments/1679296949642.35/wat/"
           "CC-MAIN-20230331113819-20230331143819-00137.warc.wat.gz")


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(fn("s").alias("o")).first().o


def test_golden_file_name_of_url(spark):
    assert one(spark, WAT_URL, file_name_of_url) == "CC-MAIN-20230331113819-20230331143819-00137.warc.wat.gz"


@pytest.mark.parametrize("value, expected", [
    ("a/b/c.gz", "c.gz"), ("noslash", ""), ("a/b/", ""), ("/", ""), ("", ""),
    ("a/b?x=/y", "y"), ("http://h/p/f.gz?x=1", "f.gz?x=1"), (None, None),
])
def test_file_name_of_url_cases(spark, value, expected):
    assert one(spark, value, file_name_of_url) == expected


@pytest.mark.parametrize("value, expected", [
    ("a/b/c.gz", "c.gz"), ("noslash", "noslash"), ("a/b/", "b"), ("/", ""), ("", ""),
    ("a/b?x=/y", "y"), ("hdfs://nn:9000/wat/f.warc.wat.gz", "f.warc.wat.gz"), (None, None),
])
def test_file_name_of_path_cases(spark, value, expected):
    assert one(spark, value, file_name_of_path) == expected


def test_golden_warc_to_wat_row(spark):
    assert one(spark, WARC, warc_name_to_wat_url) == WAT_URL


def test_s10_every_warc_is_rewritten(spark):
    got = one(spark, "a.warc/warc/b.warc.gz", warc_name_to_wat_url)
    assert got == WAT_URL_PREFIX + "a.warc.wat/wat/b.warc.wat.gz"


def test_warc_to_wat_keeps_other_columns_in_order_and_null(spark):
    df = spark.createDataFrame([(1, WARC, "x"), (2, None, "y")], "k int, warc_filename string, z string")
    out = warc_to_wat(df)
    assert out.columns == ["k", "z", "full_wat_path"]
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, "x", WAT_URL), (2, "y", None)]


def test_count_argument():
    assert is_count_arg("10") and is_count_arg("0")
    assert not is_count_arg("-1") and not is_count_arg("1.5") and not is_count_arg("") \
        and not is_count_arg("ten")


def model_name_of_url(url: str) -> str:
    """Text after the last '/', empty when there is none or it is last."""
    i = url.rfind("/")
    return url[i + 1:] if 0 <= i < len(url) - 1 else ""


def model_name_of_path(path: str) -> str:
    """Last non-empty '/'-separated part (empty for slashes only)."""
    parts = [p for p in path.split("/") if p]
    return parts[-1] if parts else ""


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

NAME_PIECES = st.sampled_from(["/", "//", "a", "b.gz", "?x=/y", "wat", ".warc", " ", "\n", "é", "."])


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(NAME_PIECES, max_size=6).map("".join), min_size=1, max_size=20))
def test_property_name_functions_match_models(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: (r.u, r.p) for r in df.select(
        "i", file_name_of_url("s").alias("u"), file_name_of_path("s").alias("p")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (model_name_of_url(v), model_name_of_path(v)), repr(v)


WARC_PIECES = st.sampled_from(["/warc/", "warc", ".warc", ".warc.gz", "/", "crawl-data", "x",
                               "/warc/warc/", ".WARC", "\n", "é"])


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(WARC_PIECES, max_size=6).map("".join), min_size=1, max_size=20))
def test_property_warc_to_wat_matches_model(spark, values):
    import re

    def model(v):
        return WAT_URL_PREFIX + re.sub(r"\.warc", ".warc.wat", re.sub("/warc/", "/wat/", v))

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.o for r in df.select("i", warc_name_to_wat_url("s").alias("o")).collect()}
    for i, v in enumerate(values):
        assert got[i] == model(v), repr(v)
