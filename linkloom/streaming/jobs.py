"""The streaming extract jobs as data, and how to run them.

Every job has the same shape: file-stream source (rate-limited by
``maxFilesPerTrigger``) -> filter -> optional ``url`` projection -> append to a
table, with its own checkpoint. They are stateless: no shuffle, no state store,
no watermark.

A table may be appended to by several jobs (see ``sinks``): it is filled either
by one fan-in job (all their rules in one scan of the raw table) or by the
single jobs, in any order and from the library or the command line. A
downstream job streams from the table as a whole, at its own rate, and a job
restarted from its checkpoint neither skips nor repeats a file, however old the
file is. Tables are folders below one base folder, or tables of one catalog
database (``base="catalog:db"``).

With a ``ledger`` the raw table is read by committed ingest runs: the stream
takes rows of the ledger's commits table and reads the partitions of these
runs, so rows of a run that is being written, or was cut off, are never seen.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import (BMP, CHOSUN, DAUM, JOINS, JP, JPEG, JPG, KR, MUSINSA, NATE, PNG,
                               Rule, all_of, suffix_pruning, url_present)
from ..operators.fanin import tag_rules
from ..operators.ledger import companion, read_runs
from ..schema import BATCH_COLUMN, COMMIT_SCHEMA, JOB_COLUMN, URL_SCHEMA
from ..session import join_path
from ..sources.files import path_exists, read_table, table_exists
from ..tables import CATALOG_PREFIX, DEFAULT_FORMAT, LinkTable, as_table
from .sinks import job_path, owner, start_batches
from .sources import file_stream, resolve_rate

RAW = "raw"
FAN_IN = "fan_in"


@dataclass(frozen=True)
class StreamSpec:
    name: str
    title: str
    source: str
    sink: str
    rules: tuple[Rule, ...]
    require_url: bool = False
    url_only: bool = True
    max_files: int = 1

    def transform(self, df: DataFrame) -> DataFrame:
        cond = all_of(*self.rules)
        if self.require_url:
            cond = url_present() & cond
        pruning = suffix_pruning(df.columns, self.rules)
        out = df.where(cond if pruning is None else pruning & cond)
        return out.select("url") if self.url_only else out


# The twelve jobs (source table, sink table, rules, files per batch).
STREAMS: tuple[StreamSpec, ...] = (
    StreamSpec("st1", "Japanese links", RAW, "jp_http_links", (JP,)),
    StreamSpec("st2", "Japanese jpg links", "jp_http_links", "jpn_jpg_links", (JPG,),
               require_url=True, url_only=False, max_files=4),
    StreamSpec("st3", "Japanese jpeg links", RAW, "jpn_jpeg_links", (JPEG, JP), require_url=True),
    StreamSpec("st4", "Japanese png links", RAW, "jpn_png_links", (PNG, JP), require_url=True),
    StreamSpec("st5", "Japanese bmp links", RAW, "jpn_bmp_links", (BMP, JP), require_url=True),
    StreamSpec("st6", "Korean links", RAW, "kr_http_links", (KR,)),
    StreamSpec("st7", "Korean jpg links", "kr_http_links", "kr_jpg_links", (JPG,),
               require_url=True, url_only=False, max_files=4),
    StreamSpec("st8", "Joins links", RAW, "kr_http_links", (JOINS,)),
    StreamSpec("st9", "Musinsa links", RAW, "kr_http_links", (MUSINSA,)),
    StreamSpec("st10", "Daum links", RAW, "kr_http_links", (DAUM,)),
    StreamSpec("st11", "Nate links", RAW, "kr_http_links", (NATE,)),
    StreamSpec("st12", "Chosun links", RAW, "kr_http_links", (CHOSUN,)),
)
SPECS = {spec.name: spec for spec in STREAMS}


FAN_IN_SCHEMA = T.StructType([*URL_SCHEMA, T.StructField("rule", T.StringType(), True)])


@dataclass
class StreamLayout:
    """Where tables and checkpoints live."""

    base: str
    checkpoints: str
    fmt: str = DEFAULT_FORMAT
    raw_path: str | None = None
    specs: Sequence[StreamSpec] = field(default_factory=lambda: STREAMS)
    ledger: LinkTable | str | None = None

    def table(self, name: str) -> LinkTable:
        if name == RAW and self.raw_path:
            return as_table(self.raw_path, self.fmt)
        if self.base.startswith(CATALOG_PREFIX):
            return LinkTable.catalog(f"{self.base[len(CATALOG_PREFIX):]}.{name}", self.fmt)
        return LinkTable(join_path(self.base, name), self.fmt)

    def raw(self) -> str:
        return str(self.table(RAW))

    def job_folder(self, spec: StreamSpec) -> str:
        return job_path(self.table(spec.sink), spec.name)

    def checkpoint(self, spec: StreamSpec) -> str:
        return join_path(self.checkpoints, spec.name)

    def writers(self, table: str) -> list[StreamSpec]:
        return [s for s in self.specs if s.sink == table]

    def fan_in_folder(self, table: str) -> str:
        return job_path(self.table(table), FAN_IN)

    def fan_in_checkpoint(self, table: str) -> str:
        return join_path(self.checkpoints, f"{FAN_IN}-{table}")

    def begun(self, spark: SparkSession, table: str) -> list[StreamSpec]:
        """The single jobs that have started to write a table."""
        return [s for s in self.writers(table) if owner(spark, self.table(table), s.name) is not None]

    def source(self, spark: SparkSession, name: str) -> LinkTable:
        """A table to stream from; one that no job has written yet is an error."""
        if name != RAW and not self.writers(name):
            raise KeyError(f"no job writes table {name!r}")
        table = self.table(name)
        there = table_exists(spark, table) if table.in_catalog else path_exists(spark, table.path)
        if not there:
            raise FileNotFoundError(f"no job has written table {name!r} yet")
        return table

    def fans_in(self, table: str) -> bool:
        """Whether one scan of the raw table can feed the table."""
        writers = self.writers(table)
        return len(writers) > 1 and all(
            s.source == RAW and s.url_only and not s.require_url and len(s.rules) == 1 for s in writers)


def _source(spark: SparkSession, layout: StreamLayout, table: str,
            max_files: int) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], T.StructType]:
    """What a job streams from; the table's rows of one of its batches; their schema."""
    handle = layout.source(spark, table)
    if table == RAW and layout.ledger is not None:
        commits = companion(layout.ledger, "commits")
        schema = read_table(spark, handle).schema

        def rows(batch: DataFrame) -> DataFrame:
            return read_runs(spark, handle, [r.run_id for r in batch.select("run_id").distinct().collect()])

        return file_stream(spark, COMMIT_SCHEMA, commits, max_files), rows, schema
    stream = read_table_stream(spark, layout, table, max_files)
    return stream, lambda batch: batch, stream.schema


def read_table_stream(spark: SparkSession, layout: StreamLayout, table: str,
                      max_files: int) -> DataFrame:
    """The table as one stream of ``max_files`` files a batch, whatever jobs wrote them."""
    handle = layout.source(spark, table)
    schema = None if handle.in_catalog else read_table(spark, handle).schema if table == RAW else URL_SCHEMA
    stream = file_stream(spark, schema, handle, max_files)
    return stream if table == RAW else stream.select("url")


def read_table_batch(spark: SparkSession, layout: StreamLayout, table: str) -> DataFrame:
    """The content of a table; of a raw table with a ledger, its committed runs."""
    handle = layout.source(spark, table)
    if table != RAW:
        return read_table(spark, handle).select("url")
    return read_table(spark, handle) if layout.ledger is None else read_runs(spark, handle, None, layout.ledger)


def read_job(spark: SparkSession, layout: StreamLayout, spec: StreamSpec) -> DataFrame:
    """What one job has written."""
    df = read_table(spark, layout.table(spec.sink)).where(F.col(JOB_COLUMN) == spec.name)
    return df.drop(JOB_COLUMN, BATCH_COLUMN)


def start_fan_in(spark: SparkSession, layout: StreamLayout, sink: LinkTable, checkpoint: str,
                 rules: Sequence[Rule], max_files: int | str | None = None,
                 available_now: bool = True, apart_from: Sequence[str] = ()) -> StreamingQuery:
    """Several selections of the raw table as one streaming query: one scan,
    one checkpoint. It writes ``rule, url`` partitioned by ``rule``; a url
    matching two rules is stored twice, as it would be by two appending jobs."""
    source, rows, _ = _source(spark, layout, RAW, resolve_rate(max_files))
    return start_batches(source, lambda batch: tag_rules(rows(batch), rules), FAN_IN_SCHEMA, sink, FAN_IN, checkpoint,
                         ("rule",), available_now, apart_from=apart_from)


def start_feed(spark: SparkSession, layout: StreamLayout, table: str, max_files: int | str | None = None,
               available_now: bool = True) -> StreamingQuery:
    """The fan-in job of a table that several raw-fed jobs append to. Refused
    where one of these jobs writes the table."""
    writers = layout.writers(table)
    return start_fan_in(spark, layout, layout.table(table), layout.fan_in_checkpoint(table),
                        [s.rules[0] for s in writers], max_files, available_now, [s.name for s in writers])


def feed_table(spark: SparkSession, layout: StreamLayout, table: str,
               max_files: int | str | None = None) -> None:
    start_feed(spark, layout, table, max_files).awaitTermination()


def start_stream(spark: SparkSession, spec: StreamSpec, layout: StreamLayout,
                 available_now: bool = True, max_files: int | str | None = None) -> StreamingQuery:
    """Start one job. With ``available_now`` it takes every file present at
    start (in batches of ``max_files``) and stops; otherwise it keeps running
    on the default trigger, as a resident job. Refused where the fan-in writes
    its table."""
    source, rows, schema = _source(spark, layout, spec.source, resolve_rate(max_files, spec.max_files))
    empty = spark.createDataFrame([], schema)
    return start_batches(source, lambda batch: spec.transform(rows(batch)), spec.transform(empty).schema,
                         layout.table(spec.sink), spec.name, layout.checkpoint(spec), (), available_now,
                         f"linkloom_{spec.name}", (FAN_IN,))


def run_stream(spark: SparkSession, spec: StreamSpec | str, layout: StreamLayout,
               with_upstream: bool = True, max_files: int | str | None = None) -> None:
    """Run a job to completion; first, what feeds its source: one fan-in job
    where several raw-fed jobs append to it, else the jobs side by side. A
    source that single jobs have begun to fill is continued by those jobs."""
    spec = SPECS[spec] if isinstance(spec, str) else spec
    if with_upstream and spec.source != RAW:
        feeders = layout.writers(spec.source)
        begun = layout.begun(spark, spec.source)
        if layout.fans_in(spec.source) and not begun:
            feed_table(spark, layout, spec.source, max_files)
        else:
            for job in begun or feeders:
                run_stream(spark, job, layout, True, max_files)
    start_stream(spark, spec, layout, available_now=True, max_files=max_files).awaitTermination()
