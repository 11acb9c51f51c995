"""Exactly-once ingest of crawl-metadata files as a file stream.

The stream's checkpoint is the ledger: a file is taken once by its base
name (``fileNameOnly``), so the same file arriving in another folder is
skipped however much later it comes. The stream carries file names, not rows;
each micro-batch reads its files in one scan and writes them as one partition
``job=<name>/batch=<n>`` of the raw table (see ``sinks``), so a crash between
writing and recording cannot repeat a file, and several ingest jobs may fill
one raw table. Optionally the consumed files are moved to an archive folder
once a later batch commits.

A file that cannot be read whole does not stop the stream: its batch goes on
without it, and its name and error are in the quarantine table
(``read_stream_quarantine``) before the batch appears. The file may come again
under another name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import file_name_of_path
from ..functions.rules import SUFFIX_COLUMN
from ..operators.filters import link_columns, with_url_suffix
from ..operators.ledger import companion, read_ledger
from ..plans.ingest import write_readable
from ..schema import FILE_SCHEMA, LINK_SCHEMA, QUARANTINE_SCHEMA
from ..sources.files import read_table
from ..tables import DEFAULT_FORMAT, LinkTable, as_table
from .sinks import start_batches, write_batch
from .sources import file_stream, resolve_rate

JOB = "ingest"


def start_ingest_stream(spark: SparkSession, wat_path: str, raw_path: LinkTable | str, checkpoint: str,
                        max_files: int | str | None = None, archive_dir: str | None = None,
                        fmt: str = DEFAULT_FORMAT, available_now: bool = True,
                        partition_by_suffix: bool = False, job: str = JOB) -> StreamingQuery:
    raw = as_table(raw_path, fmt)
    quarantine = companion(raw, "quarantine")
    parts = (SUFFIX_COLUMN,) if partition_by_suffix else ()
    options = {"fileNameOnly": True}
    if archive_dir:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    names = file_stream(spark, FILE_SCHEMA, LinkTable(wat_path, "binaryFile"), resolve_rate(max_files),
                        **options).select("path")

    def shaped(links: DataFrame) -> DataFrame:
        return with_url_suffix(links) if partition_by_suffix else links

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = sorted({r.path for r in batch.collect()})  # at most the rate
        found: list[tuple[str, str]] = []

        def put(links: DataFrame) -> None:
            if found:  # before the batch appears
                bad = spark.createDataFrame(found, "path string, error string").select(
                    file_name_of_path("path").alias("file_name"), "path", F.lit(f"{job}-{batch_id}").alias("run_id"), "error")
                write_batch(bad, quarantine, job, batch_id)
            write_batch(shaped(links), raw, job, batch_id, parts)

        write_readable(spark, paths, put, found)

    schema = shaped(spark.createDataFrame([], LINK_SCHEMA)).schema
    return start_batches(names, shaped, schema, raw, job, checkpoint, parts, available_now, write=write)


def run_ingest_stream(spark: SparkSession, wat_path: str, raw_path: LinkTable | str, checkpoint: str,
                      max_files: int | str | None = None, archive_dir: str | None = None,
                      fmt: str = DEFAULT_FORMAT, job: str = JOB) -> None:
    start_ingest_stream(spark, wat_path, raw_path, checkpoint, max_files, archive_dir,
                        fmt, job=job).awaitTermination()


def read_raw(spark: SparkSession, raw_path: LinkTable | str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The links of a raw table, whatever jobs wrote them."""
    return link_columns(read_table(spark, as_table(raw_path, fmt)))


def read_stream_quarantine(spark: SparkSession, raw_path: LinkTable | str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """``file_name, path, run_id, error`` of files that the streams could not read."""
    return read_ledger(spark, companion(as_table(raw_path, fmt), "quarantine"), QUARANTINE_SCHEMA)
