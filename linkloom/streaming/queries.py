"""Registered streaming queries.

Each query streams from the stored synthetic link table (several parquet
files; ``resume`` writes its own in two appends), runs the job(s) with
``availableNow`` (every present file, ``maxFilesPerTrigger`` at a time, then
stop) into fresh tables and checkpoints and returns a batch read of the
table. The oracle is the same selection as plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import KR_FAN_IN, Rule
from ..operators.fanin import tag_rules
from ..plans import oracle as O
from ..plans.queries import register
from ..plans.ingest import ingest_wat_files
from ..schema import RUN_COLUMN
from ..session import join_path, new_work_dir
from ..sinks.tables import append_table, create_database
from ..sources.derived import (raw_links_table, stored_links, synthetic_links, wat_files_folder,
                               write_wat_files)
from ..sources.files import copy_file, list_files, read_table, set_modified
from ..tables import LinkTable
from .fanin import run_fan_in
from .ingest import read_raw, read_stream_quarantine, run_ingest_stream
from .jobs import (RAW, SPECS, STREAMS, StreamLayout, StreamSpec, feed_table, read_job, read_table_batch,
                   run_stream, start_feed)


def write_raw_links(spark: SparkSession, sf_dir: str, path: str, n_files: int | None = None,
                    links: DataFrame | None = None) -> None:
    """Append the synthetic links to ``path``. Files follow the scan's
    partitions (no shuffle); ``n_files`` forces an exact count (tests)."""
    links = synthetic_links(spark, sf_dir) if links is None else links
    append_table(links if n_files is None else links.repartition(n_files), path)


def new_layout(spark: SparkSession, label: str, raw_path: str | None = None) -> StreamLayout:
    """Fresh folders for sinks and checkpoints; the raw table is shared
    (streams only read it) unless the query writes its own."""
    work = new_work_dir(spark, label)
    return StreamLayout(base=join_path(work, "tables"), checkpoints=join_path(work, "checkpoints"),
                        raw_path=raw_path)


def spec_sql(spec: StreamSpec) -> str:
    """Plain SQL for what a job's sink holds after the whole input ran through."""
    if spec.source == RAW:
        source = O.SYNTHETIC_LINKS
    else:
        source = "\nUNION ALL\n".join(spec_sql(w) for w in STREAMS if w.sink == spec.source)
    conds = [O.rule_sql(r) for r in spec.rules]
    if spec.require_url:
        conds.insert(0, "url IS NOT NULL")
    return f"SELECT url FROM ({source}) WHERE {' AND '.join(conds)}"


def _stream_query(spec: StreamSpec) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout = new_layout(spark, f"stream-{spec.name}", raw_links_table(spark, sf_dir))
        run_stream(spark, spec, layout)
        return read_job(spark, layout, spec)

    register(f"stream_{spec.name}", spec_sql(spec))(run)


for _spec in STREAMS:
    _stream_query(_spec)


_FAN_IN_SQL = O.fan_in_sql(O.SYNTHETIC_LINKS)


@register("fan_in", _FAN_IN_SQL)
def q_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch: one scan, one row per (link, matching rule)."""
    return tag_rules(stored_links(spark, sf_dir), KR_FAN_IN)


@register("stream_fan_in", _FAN_IN_SQL)
def q_stream_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = new_layout(spark, "fanin", raw_links_table(spark, sf_dir))
    sink = join_path(layout.base, "kr_http_links_by_rule")
    run_fan_in(spark, layout, sink, join_path(layout.checkpoints, "fan_in"))
    return read_table(spark, sink).select("rule", "url")


@register("stream_kr_chain_table", f"""
SELECT url FROM ({' UNION ALL '.join(spec_sql(s) for s in STREAMS if s.sink == 'kr_http_links')})""")
def q_stream_kr_chain_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Korean link table as its six jobs fill it (duplicates kept), in one scan."""
    layout = new_layout(spark, "krtable", raw_links_table(spark, sf_dir))
    feed_table(spark, layout, "kr_http_links")
    return read_table_batch(spark, layout, "kr_http_links")


@register("stream_resume", spec_sql(SPECS["st1"]))
def q_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restart from the checkpoint: the input arrives in two appends (all
    rows between them); each run takes only the new files, a run with no
    new file adds nothing."""
    layout = new_layout(spark, "resume")
    links = synthetic_links(spark, sf_dir)
    is_n = F.coalesce(F.col("text") == "N", F.lit(False))
    spec = SPECS["st1"]
    counts = []
    for part in (links.where(~is_n), links.where(is_n), None):
        if part is not None:
            write_raw_links(spark, sf_dir, layout.raw(), links=part)
        run_stream(spark, spec, layout)
        counts.append(read_job(spark, layout, spec).count())
    if not (counts[0] <= counts[1] == counts[2]):
        raise RuntimeError(f"resume counts not monotone: {counts}")
    return read_job(spark, layout, spec)


@register("stream_ingest", O.WAT_LINKS)
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata files -> raw table as a stream; a second run adds nothing."""
    work = new_work_dir(spark, "streamingest")
    wat = wat_files_folder(spark, sf_dir)
    raw, ckpt = join_path(work, "raw"), join_path(work, "checkpoint")
    run_ingest_stream(spark, wat, raw, ckpt)
    first = read_raw(spark, raw).count()
    run_ingest_stream(spark, wat, raw, ckpt)
    if read_raw(spark, raw).count() != first:
        raise RuntimeError("second ingest run added rows")
    return read_raw(spark, raw)


@register("stream_ingest_archive", O.WAT_LINKS)
def q_stream_ingest_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest stream moving consumed files to an archive folder: a file
    moves once a later batch has committed, and every link is taken once."""
    work = new_work_dir(spark, "streamarchive")
    wat = write_wat_files(spark, sf_dir, join_path(work, "wat"))
    raw, archive = join_path(work, "raw"), join_path(work, "archive")
    n_files = list_files(spark, wat).count()
    # About four micro-batches: files move once a later batch has committed.
    run_ingest_stream(spark, wat, raw, join_path(work, "checkpoint"),
                      max_files=max(1, n_files // 4), archive_dir=archive)
    if n_files >= 2:
        archived = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                    .load(archive).select("path").count())
        if archived == 0:
            raise RuntimeError("no consumed file was archived")
    return read_raw(spark, raw)


DAY_MS = 86_400_000


@register("stream_late_file", spec_sql(SPECS["st1"]))
def q_stream_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive late, with a modification time twenty days behind
    what the stream has already seen, are taken like any other."""
    layout = new_layout(spark, "late")
    links = synthetic_links(spark, sf_dir)
    is_n = F.coalesce(F.col("text") == "N", F.lit(False))
    spec = SPECS["st1"]
    write_raw_links(spark, sf_dir, layout.raw(), links=links.where(~is_n))
    run_stream(spark, spec, layout)
    early = {r.path for r in list_files(spark, layout.raw(), "*.parquet").collect()}
    write_raw_links(spark, sf_dir, layout.raw(), links=links.where(is_n))
    for r in list_files(spark, layout.raw(), "*.parquet").collect():
        if r.path not in early:
            set_modified(spark, r.path, -20 * DAY_MS)
    run_stream(spark, spec, layout)
    return read_job(spark, layout, spec)


@register("stream_same_name", O.WAT_LINKS)
def q_stream_same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file comes again in another folder twenty days later: its name is
    known, so nothing is taken twice."""
    work = new_work_dir(spark, "samename")
    first, second = join_path(work, "wat", "first"), join_path(work, "wat", "second")
    write_wat_files(spark, sf_dir, first)
    raw, checkpoint = join_path(work, "raw"), join_path(work, "checkpoint")
    run_ingest_stream(spark, join_path(work, "wat", "*", "*.gz"), raw, checkpoint)
    for r in list_files(spark, first, "*.gz").collect():
        target = join_path(second, r.path.rsplit("/", 1)[1])
        copy_file(spark, r.path, target)
        set_modified(spark, target, 20 * DAY_MS)
    for _ in range(2):
        run_ingest_stream(spark, join_path(work, "wat", "*", "*.gz"), raw, checkpoint)
    return read_raw(spark, raw)


@register("stream_ingest_two", O.WAT_LINKS)
def q_stream_ingest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingest streams (even and odd pages) into one raw table."""
    work = new_work_dir(spark, "ingesttwo")
    raw = join_path(work, "raw")
    for job, parity in (("even", 0), ("odd", 1)):
        wat = write_wat_files(spark, sf_dir, join_path(work, f"wat-{job}"),
                              where=F.col("page_id") % 2 == parity)
        run_ingest_stream(spark, wat, raw, join_path(work, f"checkpoint-{job}"), job=job)
    return read_raw(spark, raw)


_KR_SQL = f"""
SELECT url FROM ({' UNION ALL '.join(spec_sql(s) for s in STREAMS if s.sink == 'kr_http_links')})"""


@register("stream_fan_in_two_starts", _KR_SQL)
def q_stream_fan_in_two_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fan-in started as the command line does, new files, then the chained
    jpg job, which continues the same fan-in: no link is lost or doubled."""
    layout = new_layout(spark, "twostarts")
    links = synthetic_links(spark, sf_dir)
    is_n = F.coalesce(F.col("text") == "N", F.lit(False))
    write_raw_links(spark, sf_dir, layout.raw(), links=links.where(~is_n))
    start_feed(spark, layout, "kr_http_links").awaitTermination()
    write_raw_links(spark, sf_dir, layout.raw(), links=links.where(is_n))
    run_stream(spark, "st7", layout)
    return read_table_batch(spark, layout, "kr_http_links")


@register("stream_single_writers", _KR_SQL)
def q_stream_single_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six Korean jobs as jobs of their own, appending to one table in two
    rounds and in another order each, with new files between."""
    layout = new_layout(spark, "singles")
    links = synthetic_links(spark, sf_dir)
    is_n = F.coalesce(F.col("text") == "N", F.lit(False))
    jobs = layout.writers("kr_http_links")
    for part, order in ((~is_n, jobs), (is_n, jobs[::-1])):
        write_raw_links(spark, sf_dir, layout.raw(), links=links.where(part))
        for spec in order:
            run_stream(spark, spec, layout, max_files=100)
    return read_table_batch(spark, layout, "kr_http_links")


@register("stream_ingest_bad_file", O.WAT_LINKS)
def q_stream_ingest_bad_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cut-off gzip comes first, alone in the folder; good files come later.
    All their links arrive, and the bad name is in the quarantine table."""
    work = new_work_dir(spark, "streambad")
    wat, raw, checkpoint = (join_path(work, n) for n in ("wat", "raw", "checkpoint"))
    good = wat_files_folder(spark, sf_dir)
    listed = [r.path for r in list_files(spark, good, "*.gz").orderBy("path").collect()]
    copy_file(spark, listed[0], join_path(wat, "cut off.gz"), keep=0.6)
    run_ingest_stream(spark, wat, raw, checkpoint)
    for path in listed:
        copy_file(spark, path, join_path(wat, path.rsplit("/", 1)[1]))
    run_ingest_stream(spark, wat, raw, checkpoint, max_files=max(1, len(listed) // 2))
    bad = [r.file_name for r in read_stream_quarantine(spark, raw).collect()]
    if bad != ["cut off.gz"]:
        raise RuntimeError(f"quarantined {bad}")
    return read_raw(spark, raw)


def _new_database(spark: SparkSession, label: str) -> str:
    name = f"linkloom_{label}_" + new_work_dir(spark, label).rsplit("-", 1)[1]
    create_database(spark, name)
    return name


@register("stream_st1_catalog", spec_sql(SPECS["st1"]))
def q_stream_st1_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Japanese job from a catalog table to a catalog table, started twice."""
    base = f"catalog:{_new_database(spark, 'st1')}"
    layout = StreamLayout(base=base, checkpoints=new_work_dir(spark, "st1catalog"))
    links = synthetic_links(spark, sf_dir)
    is_n = F.coalesce(F.col("text") == "N", F.lit(False))
    for part in (~is_n, is_n):
        append_table(links.where(part), layout.table(RAW))
        run_stream(spark, "st1", layout)
    return read_job(spark, layout, SPECS["st1"])


@register("stream_committed_runs", f"""
SELECT url FROM ({O.WAT_LINKS}) WHERE lower(url) LIKE '%/%'""")
def q_stream_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over a catalog table that batch ingest fills: it sees the runs
    that have their commit row, also those finished later, and no row of a run
    that was cut off between two partitions."""
    work = new_work_dir(spark, "committed")
    db = _new_database(spark, "runs")
    raw, ledger = LinkTable.catalog(f"{db}.raw"), LinkTable(join_path(work, "ledger"))
    wat = wat_files_folder(spark, sf_dir)
    spec = StreamSpec("slash", "links with a slash", RAW, "slash_links", (Rule("slash", "%/%", "any"),))
    layout = StreamLayout(base=join_path(work, "tables"), checkpoints=join_path(work, "ckpt"),
                          raw_path=f"catalog:{db}.raw", specs=(spec,), ledger=ledger)
    for glob in ("*0.txt.gz", "*.gz"):
        ingest_wat_files(spark, wat, ledger, raw, glob=glob)
        torn = spark.table(raw.name).limit(5).withColumn(RUN_COLUMN, F.lit("torn-run"))
        torn.write.mode("append").insertInto(raw.name)
        run_stream(spark, spec, layout)
    if read_table_batch(spark, layout, RAW).where(F.col(RUN_COLUMN) == "torn-run").count():
        raise RuntimeError("a reader saw rows of a run without its commit")
    return read_job(spark, layout, spec)
