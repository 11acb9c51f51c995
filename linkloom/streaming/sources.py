"""File streams, and who writes which raw folder.

Spark forgets a file whose modification time is a week behind the newest one
it has seen (``maxFileAge``): it would skip files that arrive late with an old
time, and read a known name again. Every file stream here is built by
``file_stream``, which puts that limit out of the way.

A table is one stream: its folder, or its name in the catalog, whatever jobs
write it. So a rate holds for the table as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import JOB_COLUMN
from ..sources.files import list_names, path_exists
from ..tables import LinkTable

NO_AGE_LIMIT = "36500d"
FILES_PER_BATCH = 1_000  # the rate of jobs that have none of their own
AUTO = "auto"
JOB_FOLDER = f"{JOB_COLUMN}="


def resolve_rate(max_files: int | str | None, default: int = FILES_PER_BATCH) -> int:
    """Files a micro-batch admits: the given rate, else the job's own;
    ``"auto"`` is the general rate. Jobs are stateless, so the rate changes
    throughput only, never the rows."""
    if max_files is None:
        return default
    return FILES_PER_BATCH if max_files == AUTO else int(max_files)


def file_stream(spark: SparkSession, schema: T.StructType | None, table: LinkTable, max_files: int,
                **options) -> DataFrame:
    """The files of a path table (or folder), or of a catalog table, as a stream."""
    reader = (spark.readStream.option("maxFilesPerTrigger", max_files).option("maxFileAge", NO_AGE_LIMIT)
              .options(**options))
    if table.in_catalog:
        return reader.table(table.name)
    return reader.schema(schema).format(table.fmt).load(table.path)


def refuse_stream_folder(spark: SparkSession, folder: str) -> None:
    """A batch job must not write into a table whose partitions are streams' batches."""
    names = list_names(spark, folder) if path_exists(spark, folder) else []
    if any(n.startswith(JOB_FOLDER) for n in names):
        raise RuntimeError(f"{folder} is written by ingest streams")
