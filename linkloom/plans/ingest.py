"""Ingest crawl-metadata files into the raw link table, each file once.

Batch form: list the folder once, drop the names already in the ledger (anti
join), store what is pending and number it into runs of at most
``FILES_PER_RUN`` files. Each run is one multi-path scan (one task per gzip
file, all in parallel) and one write. Only a run's own paths reach the driver
(to hand them to the reader), never the listing and never rows.

A run survives a crash at any point:

1. the intents of all runs of a call (file name, path, run id) are written first;
2. its rows go to the partition ``ingest_run=<id>`` of the raw table;
   unreadable files, if any, are recorded with their error in the quarantine
   table before the partition appears;
3. the names of the good files are appended to the ledger;
4. one row in the commits table says that the run is complete.

The commit row is the only proof. The next call (one ingest at a time per
ledger) first finishes what a crash left: a run without a commit row is
written again from its intents, replacing its whole partition, and marked
(the ledger is read as a set, so marking twice is harmless). Leaf partitions
that happen to lie in the raw table prove nothing; ``read_committed`` reads
the runs that have their proof, in batch, and streams with a ledger
(``StreamLayout.ledger``) do the same.

On a path table a run is staged below ``_staging`` and published by renaming
its one folder, so on file systems with an atomic rename any reader of the
table sees a run whole or not at all, also when a run is finished after a
crash: a folder already published is left as it is.

A file that cannot be read (a cut-off gzip) does not hold up others: where a
write fails, one narrow job finds all files of the run that are not whole
(``sources.readable``) and the run is written once more without them, so bad
files cost one more write however many they are. They stay out of the ledger
and in the quarantine table; ``retry_quarantined`` takes such files again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rules import SUFFIX_COLUMN
from ..operators.filters import with_url_suffix
from ..operators.joins import anti_join
from ..operators.ledger import companion, pending_files, read_ledger, read_runs, with_path_name
from ..schema import COMMIT_SCHEMA, INTENT_SCHEMA, QUARANTINE_SCHEMA, RUN_COLUMN, RUN_LEDGER_SCHEMA
from ..session import join_path, new_work_dir
from ..sinks.tables import append_table, is_published, overwrite_partitions, overwrite_table, staged_and_final
from ..sources.files import list_files, move_folder
from ..sources.readable import unreadable_files
from ..sources.wat import read_wat_files
from ..streaming.sources import refuse_stream_folder
from ..tables import LinkTable, as_table

FILES_PER_RUN = 10_000
FILES_PER_BUCKET = 1_000  # names numbered together by one task

# A gzip file is one task however large it is; its links are split into
# files of at most this many rows so that scans of the raw table stay parallel.
RECORDS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class IngestResult:
    files: tuple[str, ...]
    resumed: tuple[str, ...] = ()

    @property
    def count(self) -> int:
        return len(self.files)


def new_call_id() -> str:
    return time.strftime("%Y%m%d%H%M%S", time.gmtime()) + "-" + uuid.uuid4().hex[:8]


def read_quarantine(spark: SparkSession, ledger: LinkTable | str) -> DataFrame:
    """``file_name, path, run_id, error`` of files that could not be read."""
    return read_ledger(spark, companion(as_table(ledger), "quarantine"), QUARANTINE_SCHEMA)


def plan_ingest(spark: SparkSession, wat_folder: str, ledger: LinkTable | str,
                glob: str | None = None, retry_quarantined: bool = False) -> DataFrame:
    """Pending files of the folder: ``path, file_name`` (lazy)."""
    ledger = as_table(ledger)
    known = read_ledger(spark, ledger).select("file_name")
    if not retry_quarantined:
        known = known.union(read_quarantine(spark, ledger).select("file_name"))
    return pending_files(with_path_name(list_files(spark, wat_folder, glob)), known)


def read_committed(spark: SparkSession, raw_table: LinkTable | str, ledger: LinkTable | str) -> DataFrame:
    """The raw table's rows of complete runs."""
    return read_runs(spark, raw_table, None, ledger)


def write_readable(spark: SparkSession, paths: Sequence[str], write: Callable[[DataFrame], None],
                   bad: list[tuple[str, str]] | None = None) -> list[tuple[str, str]]:
    """``write`` the links of the files that can be read; returns (path, error)
    of the others (``bad`` holds them before the second write). At most two
    writes: one more if the first fails on files that are not whole."""
    bad = [] if bad is None else bad
    try:
        write(read_wat_files(spark, paths))
        return bad
    except Exception:
        bad += sorted((r.path, r.error) for r in unreadable_files(spark, paths).collect())  # of these paths
        if not bad:
            raise
    gone = {p for p, _ in bad}
    write(read_wat_files(spark, [p for p in paths if p not in gone]))
    return bad


def _folders(raw_table: LinkTable, run_id: str) -> tuple[str, str]:
    """Where a run is staged, and its place in the table."""
    return staged_and_final(raw_table, f"{RUN_COLUMN}={run_id}")


def _write_run(spark: SparkSession, paths: list[str], raw_table: LinkTable, run_id: str,
               records_per_file: int, partition_by_suffix: bool) -> list[tuple[str, str]]:
    """Write the run's readable files (staged on a path table, else into the
    run's partition); returns (path, error) of the others."""
    parts = [SUFFIX_COLUMN] if partition_by_suffix else []

    def write(links: DataFrame) -> None:
        if partition_by_suffix:
            links = with_url_suffix(links)
        if raw_table.in_catalog:
            overwrite_partitions(links.withColumn(RUN_COLUMN, F.lit(run_id)), raw_table,
                                 [RUN_COLUMN, *parts], max_records_per_file=records_per_file)
        else:
            staged = LinkTable(_folders(raw_table, run_id)[0], raw_table.fmt)
            overwrite_table(links, staged, parts, max_records_per_file=records_per_file)

    return write_readable(spark, paths, write)


def _mark(spark: SparkSession, names: DataFrame, ledger: LinkTable) -> None:
    append_table(names.select("file_name", "run_id"), ledger)


def _finish_run(spark: SparkSession, run_id: str, ledger: LinkTable, raw_table: LinkTable,
                records_per_file: int, partition_by_suffix: bool) -> tuple[str, ...]:
    """Write, commit and mark one run from its intents; returns the names taken."""
    intents = read_ledger(spark, companion(ledger, "intents"), INTENT_SCHEMA).where(F.col("run_id") == run_id)
    rows = sorted({(r.path, r.file_name) for r in intents.collect()})  # at most FILES_PER_RUN
    published = False
    if not raw_table.in_catalog:
        staged, final = _folders(raw_table, run_id)
        published = is_published(spark, staged, final)
    if published:  # renamed before a crash: complete, and its bad files are recorded
        bad = [(r.path, r.error) for r in
               read_quarantine(spark, ledger).where(F.col("run_id") == run_id).collect()]
    else:
        bad = _write_run(spark, [p for p, _ in rows], raw_table, run_id, records_per_file,
                         partition_by_suffix)
        if bad:
            names = dict(rows)
            append_table(spark.createDataFrame([(names[p], p, run_id, e) for p, e in bad],
                                               QUARANTINE_SCHEMA), companion(ledger, "quarantine"))
        if not raw_table.in_catalog:
            move_folder(spark, staged, final)
    failed = {p for p, _ in bad}
    taken = sorted({n for p, n in rows if p not in failed})
    _mark(spark, spark.createDataFrame([(n, run_id) for n in taken], RUN_LEDGER_SCHEMA), ledger)
    append_table(spark.createDataFrame([(run_id,)], COMMIT_SCHEMA), companion(ledger, "commits"))
    return tuple(taken)


def _plan_runs(spark: SparkSession, pending: DataFrame, ledger: LinkTable, files_per_run: int) -> list[str]:
    """Write the intents of all pending files, one path per name, and return
    the ids of their runs. The names are numbered bucket by bucket, so no task
    sorts all of them."""
    call = new_call_id()
    listing = join_path(new_work_dir(spark, "pending"), "files")
    pending.groupBy("file_name").agg(F.min("path").alias("path")).write.parquet(listing)
    stored = spark.read.schema("file_name string, path string").parquet(listing)
    n_files = stored.count()
    if not n_files:
        return []
    bucket = F.pmod(F.xxhash64("file_name"), F.lit(1 + n_files // FILES_PER_BUCKET))
    named = stored.withColumn("bucket", bucket)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over the buckets' counts
    counts = (named.groupBy("bucket").agg(F.count("*").alias("n"))
              .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    place = F.col("first") + F.row_number().over(Window.partitionBy("bucket").orderBy("file_name")) - 1
    run = F.format_string(f"{call}-%06d", F.floor(place / files_per_run).cast("int"))
    append_table(named.join(counts, "bucket").select("file_name", "path", run.alias("run_id")),
                 companion(ledger, "intents"))
    return [f"{call}-{i:06d}" for i in range(-(-n_files // files_per_run))]


def finish_open_runs(spark: SparkSession, ledger: LinkTable, raw_table: LinkTable,
                     records_per_file: int = RECORDS_PER_FILE,
                     partition_by_suffix: bool = False) -> tuple[str, ...]:
    """Complete runs that a crash left without their commit row (normally none)."""
    intents = read_ledger(spark, companion(ledger, "intents"), INTENT_SCHEMA)
    commits = read_ledger(spark, companion(ledger, "commits"), COMMIT_SCHEMA)
    left = anti_join(intents.select("run_id"), commits, "run_id").distinct().collect()
    finished: list[str] = []
    for run_id in sorted(r.run_id for r in left):
        finished += _finish_run(spark, run_id, ledger, raw_table, records_per_file, partition_by_suffix)
    return tuple(finished)


def ingest_wat_files(spark: SparkSession, wat_folder: str, ledger: LinkTable | str,
                     raw_table: LinkTable | str, glob: str | None = None,
                     records_per_file: int = RECORDS_PER_FILE,
                     partition_by_suffix: bool = False, retry_quarantined: bool = False,
                     files_per_run: int = FILES_PER_RUN) -> IngestResult:
    """Take every not yet processed file of the folder into the raw table;
    returns the names taken (and those of interrupted runs it finished).

    With ``partition_by_suffix`` the raw table is also partitioned by the
    url's image suffix class, so image selections read one partition.
    """
    ledger, raw_table = as_table(ledger), as_table(raw_table)
    if not raw_table.in_catalog:
        refuse_stream_folder(spark, raw_table.path)
    resumed = finish_open_runs(spark, ledger, raw_table, records_per_file, partition_by_suffix)
    pending = plan_ingest(spark, wat_folder, ledger, glob, retry_quarantined)
    taken: list[str] = []
    for run_id in _plan_runs(spark, pending, ledger, files_per_run):
        taken += _finish_run(spark, run_id, ledger, raw_table, records_per_file, partition_by_suffix)
    return IngestResult(tuple(sorted(taken)), resumed)
