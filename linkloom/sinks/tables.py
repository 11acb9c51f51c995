"""Table and file sinks.

Each write is one Spark job whose output is committed by Spark's file
committer, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import join_path
from ..sources.files import move_folder, path_exists, table_exists
from ..tables import LinkTable, as_table

# Export layout (separator and most part files per export).
EXPORT_SEPARATOR = "|"
EXPORT_MAX_FILES = 100


def _save(writer, table: LinkTable) -> None:
    if table.in_catalog:
        writer.saveAsTable(table.name)
    else:
        writer.save(table.path)


def overwrite_table(df: DataFrame, table: LinkTable | str,
                    partition_by: list[str] | None = None,
                    max_records_per_file: int | None = None) -> None:
    """Replace the table's content (creates it when absent)."""
    table = as_table(table)
    writer = df.write.mode("overwrite").format(table.fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _save(writer, table)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """SQL settings of the session for the time of one write."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def append_table(df: DataFrame, table: LinkTable | str,
                 partition_by: list[str] | None = None,
                 max_records_per_file: int | None = None) -> None:
    """Append; creates the table when it does not exist yet.

    ``max_records_per_file`` splits the output of one big task into several
    files (no shuffle), so a later scan of the table stays parallel.
    """
    table = as_table(table)
    writer = df.write.mode("append").format(table.fmt)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _save(writer, table)


def overwrite_partitions(df: DataFrame, table: LinkTable | str, partition_by: list[str],
                         max_records_per_file: int | None = None) -> None:
    """Replace only the partitions ``df`` holds (dynamic partition overwrite);
    every other partition of the table stays as it is.

    Spark stages the partitions and publishes them one by one at job commit: a
    driver lost meanwhile may leave some of them, so a caller needs a proof of
    its own that the write returned.
    """
    table = as_table(table)
    spark = df.sparkSession
    if table.in_catalog and table_exists(spark, table):
        columns = spark.table(table.name).columns
        # An insert takes these from the session; options of its writer do not reach it.
        settings = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
        if max_records_per_file:
            settings["spark.sql.files.maxRecordsPerFile"] = str(max_records_per_file)
        with session_settings(spark, settings):
            df.select(*columns).write.insertInto(table.name, overwrite=True)
        return
    writer = (df.write.mode("overwrite").format(table.fmt)
              .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    _save(writer, table)


STAGING = "_staging"


def staged_and_final(table: LinkTable, *parts: str) -> tuple[str, str]:
    """Where a partition of a path table is staged, and its place in the table."""
    return join_path(table.path, STAGING, *parts), join_path(table.path, *parts)


def is_published(spark: SparkSession, staged: str, final: str) -> bool:
    """Whether a staged folder has arrived whole: the rename takes the staged
    folder away last, also where it copies file by file."""
    return path_exists(spark, final) and not path_exists(spark, staged)


def publish(df: DataFrame, staged: str, final: str, fmt: str, partition_by: Sequence[str] = (),
            max_records_per_file: int | None = None) -> None:
    """Write the rows to the staged folder, then rename it to its place (what
    an earlier try left there is replaced)."""
    overwrite_table(df, LinkTable(staged, fmt), list(partition_by), max_records_per_file)
    move_folder(df.sparkSession, staged, final)


def create_or_append(df: DataFrame, table: LinkTable | str) -> bool:
    """Append to an existing table or create it. Returns whether it existed.

    An existing table keeps its columns: rows are matched by name, and a column
    that one side lacks is an error rather than a table with two schemas."""
    table = as_table(table)
    spark = df.sparkSession
    if not table_exists(spark, table):
        create_new_table(df, table)
        return False
    found = spark.table(table.name) if table.in_catalog else spark.read.format(table.fmt).load(table.path)
    if set(found.columns) != set(df.columns):
        raise ValueError(f"{table} has columns {found.columns}, the rows have {df.columns}")
    append_table(df.select(*[f"`{c}`" for c in found.columns]), table)
    return True


def create_new_table(df: DataFrame, table: LinkTable | str) -> None:
    """Create; fail when the table is already there."""
    table = as_table(table)
    if table.in_catalog:
        df.writeTo(table.name).using(table.fmt).create()
    else:
        df.write.mode("errorifexists").format(table.fmt).save(table.path)


def bound_files(df: DataFrame, max_files: int) -> DataFrame:
    """At most ``max_files`` write tasks (so at most that many part files).

    The rows are dealt out round-robin, so the scan and filters in front keep
    their full parallelism and only the write runs ``max_files`` tasks. The
    plan is the same at every size and nothing runs while it is built.
    """
    return df.repartition(max_files)


def export_delimited(df: DataFrame, path: str, sep: str = EXPORT_SEPARATOR,
                     max_files: int = EXPORT_MAX_FILES, null_value: str | None = None,
                     trim_spaces: bool = True) -> None:
    """Delimited text without header, at most ``max_files`` part files,
    replacing what is at ``path``.

    See ``bound_files`` for how the file bound is met. Cells holding the
    separator or a quote are quoted; null is an empty cell, an empty string
    is written as ``""``. Spark's CSV writer skips a row whose cells are all
    null (in a one-column export: every null); give ``null_value`` (for
    example ``\\N``) to write such rows with that marker instead. Like the
    original export, cells lose leading and trailing spaces (Spark's writer
    defaults); ``trim_spaces=False`` keeps them.
    """
    writer = (bound_files(df, max_files).write.mode("overwrite")
              .option("sep", sep).option("header", False))
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    if not trim_spaces:
        writer = (writer.option("ignoreLeadingWhiteSpace", False)
                  .option("ignoreTrailingWhiteSpace", False))
    writer.csv(path)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
