"""The ledger of processed files and the plan of what is still to fetch.

The ledger is a one-column table ``file_name``; the name (not the path) is
the key, so a file moved to another folder still counts as done. Checking
a listing against it is a left anti join on the name, planned by Spark
from the measured sizes. Nothing but the final, bounded plan ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import file_name_of_path, file_name_of_url
from ..schema import COMMIT_SCHEMA, LEDGER_SCHEMA, RUN_COLUMN
from ..sinks.tables import append_table
from ..sources.files import empty_frame, is_path_not_found, read_table
from ..tables import LinkTable, as_table
from .joins import anti_join


def read_ledger(spark: SparkSession, table: LinkTable | str,
                schema: T.StructType = LEDGER_SCHEMA) -> DataFrame:
    """Names already processed; a ledger that does not exist yet is empty.

    ``schema`` may ask for more columns than a ledger holds (older ledgers
    hold only ``file_name``); missing ones read as null.
    """
    table = as_table(table)
    if table.in_catalog:
        if not spark.catalog.tableExists(table.name):
            return empty_frame(spark, schema)
        found = spark.table(table.name)
        return found.select(*[F.col(f.name) if f.name in found.columns
                              else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    try:
        return spark.read.format(table.fmt).schema(schema).load(table.path)
    except AnalysisException as exc:
        if is_path_not_found(exc):
            return empty_frame(spark, schema)
        raise


def companion(ledger: LinkTable | str, kind: str) -> LinkTable:
    """A table next to the ledger: ``intents``, ``commits`` or ``quarantine``."""
    ledger = as_table(ledger)
    if ledger.in_catalog:
        return LinkTable.catalog(f"{ledger.name}_{kind}", ledger.fmt)
    return LinkTable(f"{ledger.path.rstrip('/')}_{kind}", ledger.fmt)


def read_runs(spark: SparkSession, raw_table: LinkTable | str, run_ids: Sequence[str] | None = None,
              ledger: LinkTable | str | None = None) -> DataFrame:
    """Rows of the raw table by ingest run: of the named runs (only their
    partitions are listed), or of every run that has a commit row at the
    ledger. Rows of a run that is being written, or was cut off, are left out."""
    raw_table = as_table(raw_table)
    if raw_table.in_catalog:
        spark.catalog.refreshTable(raw_table.name)  # other sessions write it too
    raw = read_table(spark, raw_table)
    if run_ids is not None:
        return raw.where(F.col(RUN_COLUMN).isin(list(run_ids)))
    commits = read_ledger(spark, companion(ledger, "commits"), COMMIT_SCHEMA)
    return raw.join(commits, raw[RUN_COLUMN] == commits["run_id"], "left_semi")


def mark_processed(names: DataFrame, table: LinkTable | str, column: str = "file_name") -> None:
    """Append names to the ledger. Marking a name twice is harmless: readers
    treat the ledger as a set."""
    append_table(names.select(F.col(column).alias("file_name")).distinct(), table)


def merge_ledger(ledger: DataFrame, names: DataFrame, column: str = "file_name") -> DataFrame:
    """Ledger plus new names, as a set."""
    return ledger.select("file_name").unionByName(
        names.select(F.col(column).alias("file_name"))).distinct()


def with_path_name(files: DataFrame, path: str = "path", out: str = "file_name") -> DataFrame:
    return files.withColumn(out, file_name_of_path(path))


def pending_files(files: DataFrame, ledger: DataFrame, name: str = "file_name") -> DataFrame:
    """Rows of ``files`` whose ``name`` is not in the ledger.

    The ledger may hold a name twice; an anti join does not care, so it goes
    to the join as it is (no extra shuffle to make it distinct).
    """
    done = ledger.select(F.col("file_name").alias(name))
    return anti_join(files, done, name)


def download_plan(urls: DataFrame, ledger: DataFrame, n: int, url: str = "value") -> DataFrame:
    """The first ``n`` files still to fetch, by url: ``file_name, url``.

    A url whose name is empty (blank line, trailing slash) cannot be fetched
    and is not planned. A name listed under several urls is planned once,
    with its smallest url. The final top-``n`` keeps at most ``n`` rows per
    partition before the single merge.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    named = (urls.select(F.col(url).alias("url"))
             .withColumn("file_name", file_name_of_url("url"))
             .where(F.col("file_name") != ""))
    todo = pending_files(named, ledger, "file_name")
    one_per_name = todo.groupBy("file_name").agg(F.min("url").alias("url"))
    return one_per_name.orderBy("url", "file_name").limit(n)
