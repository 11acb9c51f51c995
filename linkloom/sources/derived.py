"""Link-shaped inputs that Spark derives from the driver tables.

The driver tables hold no crawl metadata, so the library's queries run on
three derivations whose work grows with the tables:

* ``page_links``: every ``<a href>`` anchor of ``pages.html`` (one row per
  anchor, with the anchor text).
* ``synthetic_links``: one url per ``lineitem`` row, built from its keys so
  that it has nulls, duplicates, upper case, scheme-less and query-string
  forms and hits every selection rule.
* ``warc_names``: one WARC file name per ``orders`` row.

``write_wat_files`` turns ``page_links`` into gzipped crawl-metadata files
(JSON records after WARC header lines), which the WAT reader reads back.
Each derivation has a DuckDB twin in ``linkloom.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import SUFFIX_COLUMN, url_suffix_class
from ..schema import ENVELOPE, HTML_META, HTTP_RESPONSE, LINKS, PAYLOAD
from ..session import join_path, new_work_dir
from .files import table_exists

# Anchor patterns, the link path tag and the url pieces.
ANCHOR_PATTERN = r'<a href="[^"]*"[^>]*>[^<]*</a>'
HREF_PATTERN = r'<a href="([^"]*)"'
ANCHOR_TEXT_PATTERN = r">([^<]*)</a>$"
LINK_PATH = "A@/href"
SITE_SUFFIXES = (".co.jp/", ".co.kr/", ".kakao.com/", ".daum.net/", ".coupang.com/",
                 ".nate.com/", ".chosun.com/", ".joins.com/", ".musinsa.com/")
FILE_SUFFIXES = (".JPG", ".jpeg", ".png", ".bmp", ".jpg?w=1", "")
SCHEMES = ("//", "www.naver.com/", "https://", "https://", "https://")
SYNTHETIC_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table_path(sf_dir: str, name: str) -> str:
    return join_path(sf_dir, f"{name}.parquet")


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _null_string() -> Column:
    return F.lit(None).cast("string")


def anchors(html: Column | str = "html") -> Column:
    """Array of whole ``<a href=...>text</a>`` anchors, in page order."""
    html = F.col(html) if isinstance(html, str) else html
    return F.regexp_extract_all(html, F.lit(ANCHOR_PATTERN), F.lit(0))


def anchor_href(anchor: Column) -> Column:
    return F.regexp_extract(anchor, HREF_PATTERN, 1)


def anchor_text(anchor: Column) -> Column:
    return F.regexp_extract(anchor, ANCHOR_TEXT_PATTERN, 1)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, text``: one row per anchor of every page."""
    pages = read_driver_table(spark, sf_dir, "pages").select("page_id", "html")
    exploded = pages.select("page_id", F.explode(anchors("html")).alias("anchor"))
    return exploded.select("page_id", anchor_href(F.col("anchor")).alias("url"),
                           anchor_text(F.col("anchor")).alias("text"))


def page_link_structs(html: Column | str = "html") -> Column:
    """The anchors of one page as an array of link structs (no shuffle)."""
    return F.transform(anchors(html), lambda a: F.struct(
        F.lit(LINK_PATH).alias("path"),
        _null_string().alias("target"),
        anchor_text(a).alias("text"),
        _null_string().alias("title"),
        anchor_href(a).alias("url"),
    ))


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """``values[index]`` from a literal array (0-based, short generated code)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def synthetic_url() -> Column:
    """The url expression on ``lineitem`` keys (null for every 97th part)."""
    lk, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    url = F.concat(
        _pick(SCHEMES, ln % 5),
        F.lit("H"), (sk % 7).cast("string"),
        _pick(SITE_SUFFIXES, sk % 9),
        F.when(pk % 11 == 0, F.lit("x.kr/")).otherwise(F.lit("")),
        pk.cast("string"),
        _pick(FILE_SUFFIXES, lk % 6),
    )
    return F.when(pk % 97 == 0, _null_string()).otherwise(url)


def synthetic_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link rows with the four ``lineitem`` keys (unique together) and the
    five link columns."""
    li = read_driver_table(spark, sf_dir, "lineitem").select(*SYNTHETIC_KEYS, "l_returnflag")
    return li.select(
        *SYNTHETIC_KEYS,
        F.lit(LINK_PATH).alias("path"),
        _null_string().alias("target"),
        F.col("l_returnflag").alias("text"),
        _null_string().alias("title"),
        synthetic_url().alias("url"),
    )


_MATERIALIZED: dict[tuple[str, str, bool], str] = {}


def raw_links_table(spark: SparkSession, sf_dir: str, by_suffix: bool = False) -> str:
    """Path of the synthetic links stored as a parquet table, written once per
    session and input folder below the checkpoint root.

    This is the raw link table the selection jobs and streams read, as they
    read the ingested table in production: the url is a stored column, the
    scan pushes ``IsNotNull(url)`` and prunes columns. Files follow the
    scan's partitions (no shuffle for the write).
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), by_suffix)
    path = _MATERIALIZED.get(key)
    if path is not None and not table_exists(spark, path):
        path = None  # the work folder was removed: write it again
    if path is None:
        path = join_path(new_work_dir(spark, "rawlinks"), "raw")
        links = synthetic_links(spark, sf_dir)
        writer = links.write.mode("errorifexists")
        if by_suffix:
            writer = links.withColumn(SUFFIX_COLUMN, url_suffix_class("url")).write \
                .mode("errorifexists").partitionBy(SUFFIX_COLUMN)
        writer.parquet(path)
        _MATERIALIZED[key] = path
    return path


def stored_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored synthetic links (see ``raw_links_table``)."""
    return spark.read.parquet(raw_links_table(spark, sf_dir))


def warc_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, warc_filename`` from ``orders``."""
    return warc_names_of(read_driver_table(spark, sf_dir, "orders"))


def warc_names_of(orders: DataFrame) -> DataFrame:
    name = F.concat(F.lit("crawl-data/CC-MAIN-2023-14/segments/"),
                    (F.col("o_custkey") % 5).cast("string"),
                    F.lit("/warc/CC-MAIN-"), F.col("o_orderkey").cast("string"),
                    F.lit(".warc.gz"))
    return orders.select("o_orderkey", name.alias("warc_filename"))


def fetched_orders(orders: DataFrame) -> DataFrame:
    """Orders whose file counts as already fetched: the finished ones."""
    return orders.where(F.col("o_orderstatus") == "F")


def wat_record_json(links: Column) -> Column:
    """One crawl-metadata record around a link array, as a JSON string.

    The headers carry both spellings of the content type, as real records
    do; only a case-sensitive session can hold them.
    """
    headers = F.struct(F.lit("text/html").alias("Content-Type"),
                       F.lit("text/html; charset=UTF-8").alias("content-type"))
    html_meta = F.struct(F.struct(F.lit("").alias("Title")).alias("Head"),
                         links.alias(LINKS))
    response = F.struct(headers.alias("Headers"), html_meta.alias(HTML_META))
    payload = F.struct(response.alias(HTTP_RESPONSE))
    envelope = F.struct(F.lit("WARC").alias("Format"), payload.alias(PAYLOAD))
    return F.to_json(F.struct(envelope.alias(ENVELOPE)))


def wat_text(pages: DataFrame) -> DataFrame:
    """``pages`` -> one text value per page: two WARC header lines, a blank
    line, then the JSON record (the layout of a metadata file)."""
    return pages.select(
        F.col("page_id"),
        F.concat_ws("\n",
                    F.lit("WARC/1.0"),
                    F.concat(F.lit("WARC-Target-URI: "), F.coalesce(F.col("url"), F.lit(""))),
                    F.lit(""),
                    wat_record_json(page_link_structs("html"))).alias("value"))


def write_wat_files(spark: SparkSession, sf_dir: str, folder: str,
                    pages_per_file: int = 50, where: Column | None = None) -> str:
    """Write the pages as gzipped metadata files into ``folder`` and return it.

    The file count grows with the pages: each task cuts its output into files
    of at most ``pages_per_file`` records (no count job, no shuffle of the
    html).
    """
    pages = read_driver_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    if where is not None:
        pages = pages.where(where)
    (wat_text(pages).select("value")
     .write.mode("errorifexists").option("compression", "gzip")
     .option("maxRecordsPerFile", pages_per_file).text(folder))
    return folder


_WAT_FOLDERS: dict[tuple[str, str], str] = {}


def wat_files_folder(spark: SparkSession, sf_dir: str) -> str:
    """The pages as metadata files, written once per session and input folder
    below the checkpoint root, for queries that only read them."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    folder = _WAT_FOLDERS.get(key)
    if folder is not None and not _has_files(spark, folder):
        folder = None
    if folder is None:
        folder = write_wat_files(spark, sf_dir, join_path(new_work_dir(spark, "watfiles"), "wat"))
        _WAT_FOLDERS[key] = folder
    return folder


def _has_files(spark: SparkSession, folder: str) -> bool:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.format("binaryFile").load(folder).select("path").limit(1).count() > 0
    except AnalysisException:
        return False
