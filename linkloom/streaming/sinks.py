"""Append-only tables that several streams write.

Batch n of a job is the partition ``job=<job>/batch=<n>`` of the table, so a
batch that is replayed after a crash replaces only itself, and jobs never
touch each other's rows. In a folder a batch is staged below ``_staging`` and
published by renaming its one folder: a reader sees it whole or not at all,
and a batch already published is left as it is. In a catalog table it is
written by dynamic partition overwrite.

A job's checkpoint is what makes it exactly-once: batch numbers mean something
only together with it. ``claim`` therefore notes the checkpoint of each job in
the table and refuses to start the job with another one, which would take
every row again or write over batches that are there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import BATCH_COLUMN, JOB_COLUMN
from ..session import join_path
from ..sinks.tables import overwrite_partitions, publish, staged_and_final
from ..sources.files import list_names, path_exists, qualified, read_note, table_exists, write_note
from ..tables import LinkTable

WRITERS = "_writers"
PROPERTY = "linkloom.writer."
HIDDEN = ("_", ".")


def job_path(table: LinkTable, job: str) -> str:
    return join_path(table.path, f"{JOB_COLUMN}={job}")


def _note(table: LinkTable, job: str) -> str:
    return join_path(table.path, WRITERS, job)


def owner(spark: SparkSession, table: LinkTable, job: str) -> str | None:
    """The checkpoint of a job that writes the table, if it ever started."""
    if not table.in_catalog:
        return read_note(spark, _note(table, job))
    if not table_exists(spark, table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {table.name}").where(F.col("key") == PROPERTY + job).collect()
    return found[0]["value"] if found else None


def claim(spark: SparkSession, table: LinkTable, job: str, checkpoint: str,
          apart_from: Iterable[str] = ()) -> None:
    """Note that ``job`` writes the table from this checkpoint. Refused are
    another checkpoint of the job, a job of ``apart_from`` beside it (the same
    rows would come twice), and a folder with rows that no stream wrote."""
    checkpoint = qualified(spark, checkpoint)
    for other in apart_from:
        if owner(spark, table, other) is not None:
            raise RuntimeError(f"{table} is fed by {other}: {job} would add the same rows again "
                               "(it takes its fan-in or single jobs, not both)")
    found = owner(spark, table, job)
    if found == checkpoint:
        return
    if found is not None:
        raise RuntimeError(f"job {job} of {table} belongs to checkpoint {found}, not to {checkpoint}")
    if table.in_catalog:
        spark.sql(f"ALTER TABLE {table.name} SET TBLPROPERTIES ('{PROPERTY}{job}' = '{checkpoint}')")
        return
    names = [n for n in list_names(spark, table.path) if not n.startswith(HIDDEN)]
    if f"{JOB_COLUMN}={job}" in names or any(not n.startswith(f"{JOB_COLUMN}=") for n in names):
        raise RuntimeError(f"{table} holds data of another writer")
    write_note(spark, _note(table, job), checkpoint)


def _create(spark: SparkSession, schema: T.StructType, table: LinkTable, partition_by: Sequence[str]) -> None:
    """The empty catalog table, so that it can be claimed and streamed from."""
    if table.in_catalog and not table_exists(spark, table):
        columns = [f for f in schema if f.name not in partition_by]
        empty = spark.createDataFrame([], T.StructType([
            *columns, T.StructField(JOB_COLUMN, T.StringType()), T.StructField(BATCH_COLUMN, T.LongType()),
            *[f for f in schema if f.name in partition_by]]))
        empty.writeTo(table.name).using(table.fmt).partitionedBy(JOB_COLUMN, BATCH_COLUMN, *partition_by).create()


def write_batch(df: DataFrame, table: LinkTable, job: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one batch of a job, replacing what an earlier try left."""
    spark = df.sparkSession
    if table.in_catalog:
        placed = df.withColumn(JOB_COLUMN, F.lit(job)).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
        overwrite_partitions(placed, table, [JOB_COLUMN, BATCH_COLUMN, *partition_by])
    else:
        publish(df, *staged_and_final(table, f"{JOB_COLUMN}={job}", f"{BATCH_COLUMN}={batch_id}"), table.fmt, partition_by)


def is_written(spark: SparkSession, table: LinkTable, job: str, batch_id: int) -> bool:
    """Whether a batch is in the table already. A catalog table cannot tell a
    whole batch from a part of one: it is written again, replacing itself."""
    if table.in_catalog:
        return False
    staged, final = staged_and_final(table, f"{JOB_COLUMN}={job}", f"{BATCH_COLUMN}={batch_id}")
    return path_exists(spark, final) and not path_exists(spark, staged)


def start_batches(source: DataFrame, make: Callable[[DataFrame], DataFrame], schema: T.StructType,
                  table: LinkTable, job: str, checkpoint: str, partition_by: Sequence[str] = (),
                  available_now: bool = True, name: str | None = None, apart_from: Iterable[str] = (),
                  write: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start a job that appends ``make(batch)`` of every micro-batch of
    ``source`` to the table. ``write`` replaces how a batch is written."""
    spark = source.sparkSession
    _create(spark, schema, table, partition_by)
    claim(spark, table, job, checkpoint, apart_from)

    def each(batch: DataFrame, batch_id: int) -> None:
        if is_written(spark, table, job, batch_id):
            return
        if write is not None:
            write(batch, batch_id)
        else:
            write_batch(make(batch), table, job, batch_id, partition_by)

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
