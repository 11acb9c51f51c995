"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables (or data Spark derives from them). Queries that must
write files (round trips, ingest, streams) write below a fresh folder of
the session's checkpoint root and return a read of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions import rules as R
from ..functions.names import file_name_of_path, file_name_of_url, warc_to_wat
from ..operators.dedup import dedup_stable, distinct_urls
from ..operators.filters import jp_jpg_jpeg, jp_png, select_links
from ..sources.derived import (SYNTHETIC_KEYS, page_links, raw_links_table, stored_links,
                               warc_names)
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return wrap


# --- links in pages -------------------------------------------------------

@register("page_links", O.PAGE_LINKS)
def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(spark, sf_dir)


@register("distinct_links", f"SELECT DISTINCT url FROM ({O.PAGE_LINKS})")
def q_distinct_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_urls(page_links(spark, sf_dir))


# --- selection rules on the synthetic urls ----------------------------------

def _rule_query(rule: R.Rule) -> None:
    sql = f"SELECT * FROM ({O.SYNTHETIC_LINKS}) WHERE url IS NOT NULL AND {O.rule_sql(rule)}"
    prefix = {"image": "img", "country": "tld", "site": "domain"}[rule.kind]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return select_links(stored_links(spark, sf_dir), rule)

    register(f"{prefix}_{rule.name}", sql)(run)


for _rule in R.ALL_RULES:
    _rule_query(_rule)


@register("img_jpg_pruned", f"""
SELECT * FROM ({O.SYNTHETIC_LINKS}) WHERE url IS NOT NULL AND {O.rule_sql(R.JPG)}""")
def q_img_jpg_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jpg selection on a raw table partitioned by url suffix class: the
    scan reads the ``url_suffix=jpg`` partition only."""
    raw = spark.read.parquet(raw_links_table(spark, sf_dir, by_suffix=True))
    return select_links(raw, R.JPG).drop(R.SUFFIX_COLUMN)


@register("jp_jpg_jpeg", f"""
SELECT * FROM ({O.SYNTHETIC_LINKS})
WHERE url IS NOT NULL AND ({O.rule_sql(R.JPG)} OR {O.rule_sql(R.JPEG)}) AND {O.rule_sql(R.JP)}""")
def q_jp_jpg_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jp_jpg_jpeg(stored_links(spark, sf_dir))


@register("jp_png", f"""
SELECT * FROM ({O.SYNTHETIC_LINKS})
WHERE url IS NOT NULL AND {O.rule_sql(R.PNG)} AND {O.rule_sql(R.JP)}""")
def q_jp_png(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jp_png(stored_links(spark, sf_dir))


# --- one row per url ---------------------------------------------------------

_KEY_ORDER = ", ".join(SYNTHETIC_KEYS)


@register("dedup_rows", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY {_KEY_ORDER}) AS rn
  FROM ({O.SYNTHETIC_LINKS}))
WHERE rn = 1""")
def q_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_stable(stored_links(spark, sf_dir), SYNTHETIC_KEYS)


# --- names ---------------------------------------------------------------------

@register("warc_to_wat", f"""
SELECT o_orderkey, {O.wat_url_sql('warc_filename')} AS full_wat_path
FROM ({O.WARC_NAMES})""")
def q_warc_to_wat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_to_wat(warc_names(spark, sf_dir))


@register("file_names", """
SELECT page_id, url, regexp_extract(url, '/([^/]*)$', 1) AS file_name FROM pages""")
def q_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", file_name_of_url("url").alias("file_name"))


@register("path_names", f"""
SELECT o_orderkey, regexp_extract(warc_filename, '([^/]+)/*$', 1) AS file_name
FROM ({O.WARC_NAMES})""")
def q_path_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = warc_names(spark, sf_dir)
    return names.select("o_orderkey", file_name_of_path("warc_filename").alias("file_name"))
