"""Selection rules: named edge cases (S2-S6) and Spark = DuckDB on any url."""

from __future__ import annotations

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import rules as R
from linkloom.operators.filters import jp_jpg_jpeg, jp_png, select_any, select_links

EDGE_URLS = [
    "httpfoo.jpg", "http.jpg", "x.jpg?w=1", "x.jpg\n", "http://a/b\nc.jpg", "HTTP://A.JP/X.JPG",
    "http://a.jp", "http://a.jp:80/x", "/p/a.jp/x", "//c.jp/x.jpg", "https://kakao.com/",
    "https://m.kakao.com/a", "www.naver.com/x", "https://www.naver.com/x", "http://b.co.kr/i.bmp",
    "http://b.daum.net/", "http://b.coupang.com/", "http://b.nate.com/", "http://b.chosun.com/",
    "http://b.joins.com/", "http://b.musinsa.com/", "http://b.jp/i.jpeg", "http://b.jp/i.png",
    "", None,
]


def frame(spark, urls):
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id int, url string")


def duck_ids(urls, pattern):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INT, url VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, u) for i, u in enumerate(urls)])
    return sorted(r[0] for r in con.execute(
        f"SELECT id FROM t WHERE url IS NOT NULL AND lower(url) LIKE '{pattern}'").fetchall())


def spark_ids(df, rule):
    return sorted(r.id for r in select_links(df, rule).collect())


@pytest.mark.parametrize("rule", R.ALL_RULES, ids=lambda r: r.name)
def test_each_rule_equals_duckdb_on_edge_urls(spark, rule):
    df = frame(spark, EDGE_URLS)
    assert spark_ids(df, rule) == duck_ids(EDGE_URLS, rule.pattern)


def test_s2_suffix_must_end_the_url_and_http_is_a_text_prefix(spark):
    df = frame(spark, EDGE_URLS)
    got = {EDGE_URLS[i] for i in spark_ids(df, R.JPG)}
    assert "httpfoo.jpg" in got and "http.jpg" in got
    assert "x.jpg?w=1" not in got and "x.jpg\n" not in got
    assert "http://a/b\nc.jpg" in got  # % crosses newlines
    assert "HTTP://A.JP/X.JPG" in got  # case folded


def test_s3_country_needs_dot_jp_slash_anywhere(spark):
    df = frame(spark, EDGE_URLS)
    got = {EDGE_URLS[i] for i in spark_ids(df, R.JP)}
    assert "http://a.jp" not in got and "http://a.jp:80/x" not in got
    assert {"/p/a.jp/x", "//c.jp/x.jpg"} <= got


def test_s4_kakao_needs_the_dot(spark):
    df = frame(spark, EDGE_URLS)
    got = {EDGE_URLS[i] for i in spark_ids(df, R.KAKAO)}
    assert got == {"https://m.kakao.com/a"}


def test_s5_naver_only_scheme_less(spark):
    df = frame(spark, EDGE_URLS)
    got = {EDGE_URLS[i] for i in spark_ids(df, R.NAVER)}
    assert got == {"www.naver.com/x"}


def test_null_url_never_passes(spark):
    df = frame(spark, [None, None])
    for rule in R.ALL_RULES:
        assert select_links(df, rule).count() == 0


def test_composites_equal_union_of_parts(spark):
    df = frame(spark, EDGE_URLS)
    jpg = {r.id for r in select_links(df, R.JPG, R.JP).collect()}
    jpeg = {r.id for r in select_links(df, R.JPEG, R.JP).collect()}
    assert {r.id for r in jp_jpg_jpeg(df).collect()} == jpg | jpeg
    assert not (jpg & jpeg)  # suffixes exclude each other: union all == or
    assert {r.id for r in jp_png(df).collect()} == {r.id for r in select_links(df, R.PNG, R.JP).collect()}
    assert select_any(df, R.JPG, R.PNG).count() == select_links(df, R.JPG).count() + select_links(df, R.PNG).count()


def test_matching_rule_names_lists_every_match(spark):
    df = frame(spark, ["http://a.co.kr/x.joins.com/y", "http://a.jp/"])
    got = {r.id: r.names for r in df.select("id", R.matching_rule_names(R.KR_FAN_IN).alias("names")).collect()}
    assert got == {0: ["kr", "joins"], 1: []}


def test_rule_predicate_stays_in_codegen_and_pushes_not_null(spark, tmp_path):
    path = str(tmp_path / "links")
    frame(spark, EDGE_URLS).write.parquet(path)
    plan = select_links(spark.read.parquet(path), R.JPG, R.JP).select("url")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "IsNotNull(url)" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


PIECES = st.sampled_from(["http", "https://", "HTTP", "www.naver.com/", ".jp/", ".kr/", ".kakao.com/",
                          ".daum.net/", "x", "/", ".jpg", ".JPEG", ".png", ".bmp", "?q=1", "\n",
                          "%", "_", ".co.jp", ":80"])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, min_size=0, max_size=6).map("".join), min_size=1, max_size=30))
def test_property_spark_equals_duckdb(spark, urls):
    df = frame(spark, urls)
    tagged = df.select("id", *[r.column().alias(r.name) for r in R.ALL_RULES]).collect()
    for rule in R.ALL_RULES:
        got = sorted(row.id for row in tagged if row[rule.name])
        assert got == duck_ids(urls, rule.pattern), rule.name


def test_rule_lookup():
    assert R.rule("png") is R.PNG
    with pytest.raises(KeyError):
        R.rule("gif")
    assert len(R.ALL_RULES) == 14 and len({r.name for r in R.ALL_RULES}) == 14
    assert F is not None


def test_suffix_partitioned_table_prunes_and_keeps_rows(spark, tmp_path):
    from linkloom.operators.filters import with_url_suffix
    path = str(tmp_path / "by_suffix")
    with_url_suffix(frame(spark, EDGE_URLS)).write.partitionBy(R.SUFFIX_COLUMN).parquet(path)
    part = spark.read.parquet(path)
    flat = frame(spark, EDGE_URLS)
    for rules in [(R.JPG,), (R.JPEG, R.JP), (R.PNG, R.JP), (R.BMP,), (R.KR,)]:
        assert sorted(r.id for r in select_links(part, *rules).collect()) == \
            sorted(r.id for r in select_links(flat, *rules).collect())
    assert sorted(r.id for r in jp_jpg_jpeg(part).collect()) == sorted(r.id for r in jp_jpg_jpeg(flat).collect())
    assert sorted(r.id for r in select_any(part, R.JPG, R.PNG).collect()) == \
        sorted(r.id for r in select_any(flat, R.JPG, R.PNG).collect())
    plan = select_links(part, R.JPG)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(url_suffix" in plan and "(url_suffix" in plan and "= jpg)" in plan
