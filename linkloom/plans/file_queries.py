"""Registered queries that write and read files: metadata round trip,
ingest, list conversion and export, ledger planning, table jobs.

Each run takes a fresh folder below the session's checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import file_name_of_url, warc_to_wat
from ..operators.filters import link_columns
from ..operators.dedup import dedup_urls
from ..operators.ledger import download_plan, merge_ledger, pending_files
from ..schema import RUN_COLUMN
from ..sinks.tables import append_table, create_database, export_delimited
from ..session import join_path, new_work_dir
from ..sources.derived import (SYNTHETIC_KEYS, fetched_orders, raw_links_table,
                               read_driver_table, stored_links, warc_names, warc_names_of,
                               wat_files_folder, write_wat_files)
from ..sources.files import copy_file, list_files, read_lines, read_table
from ..sources.wat import read_wat_links
from ..tables import LinkTable
from . import oracle as O
from .extract import audit_table, deduplicate_table, extract_jp_jpg_jpeg
from .fetch import fetch_and_mark
from .ingest import ingest_wat_files, read_committed, read_quarantine
from .queries import register
from .warc_list import convert_warc_list, load_warc_list, warc_csv_to_wat_list

PLAN_SIZE = 20


# --- crawl metadata round trip and ingest -----------------------------------

@register("wat_links", O.WAT_LINKS)
def q_wat_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_wat_links(spark, wat_files_folder(spark, sf_dir))


@register("ingest_once", O.WAT_LINKS)
def q_ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest the folder twice: the second run finds every file in the ledger."""
    work = new_work_dir(spark, "ingest")
    folder = wat_files_folder(spark, sf_dir)
    ledger, raw = LinkTable(join_path(work, "ledger")), LinkTable(join_path(work, "raw"))
    first = ingest_wat_files(spark, folder, ledger, raw)
    second = ingest_wat_files(spark, folder, ledger, raw)
    if first.count == 0 or second.count != 0:
        raise RuntimeError(f"ingest took {first.count} then {second.count} files")
    return link_columns(read_table(spark, raw))


@register("ingest_with_bad_file", O.WAT_LINKS)
def q_ingest_with_bad_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five cut-off gzip files among the files, with blanks and signs in their
    names, hold up neither their run nor later ones, and stay recorded with
    their errors."""
    work = new_work_dir(spark, "badfile")
    folder = write_wat_files(spark, sf_dir, join_path(work, "wat"))
    whole = list_files(spark, folder, "*.gz").agg(F.min("path")).first()[0]
    names = ["cut 1.gz", "cut%2.gz", "cut+3.gz", "cut[4].gz", "cut5.gz"]
    for name in names:
        copy_file(spark, whole, join_path(folder, name), keep=0.6)
    ledger, raw = LinkTable(join_path(work, "ledger")), LinkTable(join_path(work, "raw"))
    ingest_wat_files(spark, folder, ledger, raw)
    again = ingest_wat_files(spark, folder, ledger, raw)
    bad = sorted(r.file_name for r in read_quarantine(spark, ledger).select("file_name").collect())
    if again.count or bad != sorted(names):
        raise RuntimeError(f"second run took {again.files}, quarantined {bad}")
    return link_columns(read_table(spark, raw))


@register("ingest_committed", O.WAT_LINKS)
def q_ingest_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed rows of a catalog table that holds rows of a torn run."""
    work = new_work_dir(spark, "committed")
    db = "linkloom_committed_" + work.rsplit("-", 1)[1]
    create_database(spark, db)
    ledger, raw = LinkTable(join_path(work, "ledger")), LinkTable.catalog(f"{db}.raw")
    ingest_wat_files(spark, wat_files_folder(spark, sf_dir), ledger, raw)
    torn = spark.table(raw.name).limit(5).withColumn(RUN_COLUMN, F.lit("torn-run"))
    torn.write.mode("append").insertInto(raw.name)
    return link_columns(read_committed(spark, raw, ledger))


@register("fetch_ingest", O.WAT_LINKS)
def q_fetch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The download and ingest jobs end to end: metadata files in a "remote"
    folder, their urls exported as a list, every listed file fetched by the
    distributed fetch and marked, the fetched folder ingested."""
    work = new_work_dir(spark, "fetch")
    remote = wat_files_folder(spark, sf_dir)
    urls = join_path(work, "url_list")
    export_delimited(list_files(spark, remote).select(F.col("path").alias("url")), urls)
    n_files = read_lines(spark, urls).count()
    dest = join_path(work, "wat")
    report = fetch_and_mark(spark, urls, LinkTable(join_path(work, "fetched")), n_files, dest,
                            LinkTable(join_path(work, "report")), retries=2, wait_s=1.0)
    failed = report.where(~F.col("ok")).count()
    if failed:
        raise RuntimeError(f"{failed} planned file(s) did not arrive")
    raw = LinkTable(join_path(work, "raw"))
    ingest_wat_files(spark, dest, LinkTable(join_path(work, "ledger")), raw)
    return link_columns(read_table(spark, raw))


# --- delimited export and read back -------------------------------------------

_URL_ROW = T.StructType([T.StructField(k, T.LongType() if k != "l_linenumber" else T.IntegerType())
                         for k in SYNTHETIC_KEYS] + [T.StructField("url", T.StringType())])


@register("csv_round_trip", f"SELECT {', '.join(SYNTHETIC_KEYS)}, url FROM ({O.SYNTHETIC_LINKS})")
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = join_path(new_work_dir(spark, "export"), "links")
    export_delimited(stored_links(spark, sf_dir).select(*SYNTHETIC_KEYS, "url"), path)
    return spark.read.schema(_URL_ROW).option("sep", "|").csv(path)


_WAT_URLS = f"SELECT {O.wat_url_sql('warc_filename')} AS url FROM ({O.WARC_NAMES})"


@register("wat_list_export", f"SELECT url AS value FROM ({_WAT_URLS})")
def q_wat_list_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC names as a CSV with header -> WAT urls -> ``|`` text -> lines."""
    work = new_work_dir(spark, "watlist")
    csv = join_path(work, "warc_csv")
    warc_names(spark, sf_dir).select("warc_filename").write.option("header", True).csv(csv)
    out = join_path(work, "wat_list")
    warc_csv_to_wat_list(spark, csv, out)
    return read_lines(spark, out)


@register("wat_list_table", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {O.wat_url_sql('warc_filename')} AS full_wat_path
FROM ({O.WARC_NAMES})""")
def q_wat_list_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list CSV with another column in front, through both tables by
    overwrite (twice: the second replaces the first)."""
    work = new_work_dir(spark, "wattable")
    csv = join_path(work, "warc_csv")
    warc_names(spark, sf_dir).select("o_orderkey", "warc_filename").write.option("header", True).csv(csv)
    warc, wat = LinkTable(join_path(work, "warc")), LinkTable(join_path(work, "wat"))
    for _ in range(2):
        load_warc_list(spark, csv, warc)
        out = convert_warc_list(spark, warc, wat)
    return out


# --- what is still to fetch ---------------------------------------------------

_LEDGER_SQL = f"""
SELECT regexp_extract({O.wat_url_sql('warc_filename')}, '/([^/]*)$', 1) AS file_name
FROM ({O.WARC_NAMES_FETCHED})"""

_PENDING_SQL = f"""
SELECT url, regexp_extract(url, '/([^/]*)$', 1) AS file_name FROM ({_WAT_URLS})
WHERE regexp_extract(url, '/([^/]*)$', 1) NOT IN ({_LEDGER_SQL})"""


def _fetch_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The exported url list (read back as lines) and a ledger table of the
    files of finished orders."""
    work = new_work_dir(spark, "fetch")
    urls = warc_to_wat(warc_names(spark, sf_dir)).select("full_wat_path")
    export_delimited(urls, join_path(work, "wat_list"))
    done = warc_to_wat(warc_names_of(fetched_orders(read_driver_table(spark, sf_dir, "orders"))))
    ledger = LinkTable(join_path(work, "ledger"))
    append_table(done.select(file_name_of_url("full_wat_path").alias("file_name")), ledger)
    return read_lines(spark, join_path(work, "wat_list")), read_table(spark, ledger)


@register("pending_files", _PENDING_SQL)
def q_pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, ledger = _fetch_inputs(spark, sf_dir)
    listed = lines.select(F.col("value").alias("url"),
                          file_name_of_url("value").alias("file_name"))
    return pending_files(listed, ledger)


@register("download_plan", f"""
SELECT file_name, min(url) AS url FROM ({_PENDING_SQL}) WHERE file_name <> ''
GROUP BY file_name ORDER BY url, file_name LIMIT {PLAN_SIZE}""")
def q_download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, ledger = _fetch_inputs(spark, sf_dir)
    return download_plan(lines, ledger, PLAN_SIZE)


# --- table jobs -----------------------------------------------------------------

_JPG_SQL = f"""
SELECT * FROM ({O.SYNTHETIC_LINKS})
WHERE url IS NOT NULL AND (lower(url) LIKE 'http%.jpg' OR lower(url) LIKE 'http%.jpeg')
  AND lower(url) LIKE '%.jp/%'"""


@register("jpg_distinct_table", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY {', '.join(SYNTHETIC_KEYS)}) AS rn
  FROM ({_JPG_SQL}))
WHERE rn = 1""")
def q_jpg_distinct_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw table -> jpg/jpeg extract (run twice: rows doubled) -> one row per
    url into the distinct table (run twice: the second adds nothing)."""
    work = new_work_dir(spark, "jpg")
    raw = LinkTable(raw_links_table(spark, sf_dir))
    jpg, distinct = (LinkTable(join_path(work, n)) for n in ("jpg", "jpg_distinct"))
    extract_jp_jpg_jpeg(spark, raw, jpg)
    extract_jp_jpg_jpeg(spark, raw, jpg)
    for _ in range(2):
        deduplicate_table(spark, jpg, distinct, order_by=SYNTHETIC_KEYS, skip_existing=True)
    return read_table(spark, distinct)


@register("create_or_append", f"SELECT * FROM ({_JPG_SQL}) UNION ALL SELECT * FROM ({_JPG_SQL})")
def q_create_or_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract job twice into a catalog table: it is created, then appended to."""
    db = "linkloom_extract_" + new_work_dir(spark, "extract").rsplit("-", 1)[1]
    create_database(spark, db)
    raw, out = LinkTable(raw_links_table(spark, sf_dir)), LinkTable.catalog(f"{db}.jpg")
    for _ in range(2):
        extract_jp_jpg_jpeg(spark, raw, out)
    return read_table(spark, out)


@register("table_audit", f"""
SELECT 'jpn_jpg_links' AS table_name, count(*) AS row_count FROM ({_JPG_SQL})""")
def q_table_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count of a catalog table that the extract job made (its files lie in a
    fresh folder, so no run meets another's)."""
    work = new_work_dir(spark, "audit")
    table = LinkTable(join_path(work, "jpn_jpg_links"))
    extract_jp_jpg_jpeg(spark, LinkTable(raw_links_table(spark, sf_dir)), table)
    name = "jpn_jpg_links_" + work.rsplit("-", 1)[1]
    spark.catalog.createTable(name, path=table.path, source=table.fmt)
    return audit_table(spark, name).withColumn("table_name", F.lit("jpn_jpg_links"))


@register("dedup_any", f"SELECT DISTINCT url FROM ({O.SYNTHETIC_LINKS})")
def q_dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per url, whichever row survives: its urls."""
    return dedup_urls(stored_links(spark, sf_dir)).select("url")


@register("ledger_merge", f"""
SELECT file_name FROM ({_LEDGER_SQL}) UNION
SELECT file_name FROM (SELECT file_name FROM ({_PENDING_SQL}) ORDER BY url LIMIT {PLAN_SIZE})""")
def q_ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with the names of a fetched plan, as a set."""
    lines, ledger = _fetch_inputs(spark, sf_dir)
    return merge_ledger(ledger, download_plan(lines, ledger, PLAN_SIZE))
