"""Fetch planned metadata files, spread over the cluster.

The plan (``download_plan``: at most ``n`` rows) is dealt out over tasks;
each task downloads its files one by one with retries and writes them to the
destination folder through ``pyarrow.fs``. The destination is resolved by
Spark's own rules, so a path without a scheme is on the cluster's default file
system, and a folder on a machine's own disk is refused unless the session
runs on that one machine; a folder below ``spark.checkpoint.dir`` is one that
all machines mount, also where its scheme is ``file``. A file is written under
a temporary name and moved into place, so a retried task rewrites it whole. It
has arrived when the server said 200 and as many bytes came as it announced.

The outcome of every file is written as a report table in the same job that
does the downloads (so they run once), and only the files that arrived are
then marked in the ledger: a failed download stays pending for the next run.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import download_plan, mark_processed, read_ledger
from ..session import shared_folders
from ..sinks.tables import append_table
from ..sources.files import qualified, read_lines, read_table
from ..tables import LinkTable, as_table

FETCH_SCHEMA = "file_name string, url string, ok boolean, bytes long, attempts int, error string"


def _fetcher(dest: str, retries: int, wait_s: float, timeout_s: float):
    """The per-partition function. Everything it uses is defined or imported
    inside it, so it is shipped by value and executors need no copy of this
    library."""

    def run(batches):
        import time
        import urllib.request
        import uuid

        import pandas as pd
        from pyarrow import fs as pafs

        chunk = 1 << 20
        filesystem, root = pafs.FileSystem.from_uri(dest)
        filesystem.create_dir(root, recursive=True)

        def fetch_one(name: str, url: str) -> tuple:
            error = None
            for attempt in range(1, retries + 2):
                tmp = f"{root}/.{name}.{uuid.uuid4().hex[:8]}.part"
                try:
                    size = 0
                    with urllib.request.urlopen(url, timeout=timeout_s) as src, \
                            filesystem.open_output_stream(tmp) as dst:
                        status = getattr(src, "status", None)  # None for file urls
                        if status not in (None, 200):
                            raise OSError(f"status {status}")
                        announced = src.headers.get("Content-Length")
                        while True:
                            block = src.read(chunk)
                            if not block:
                                break
                            dst.write(block)
                            size += len(block)
                    if announced is not None and size != int(announced):
                        raise OSError(f"{size} of {announced} bytes came")
                    final = f"{root}/{name}"
                    if filesystem.get_file_info(final).type != pafs.FileType.NotFound:
                        filesystem.delete_file(final)  # some file systems refuse to rename onto a file
                    filesystem.move(tmp, final)
                    return name, url, True, size, attempt, None
                except Exception as exc:  # network, HTTP status, file system
                    error = f"{type(exc).__name__}: {exc}"
                    try:
                        filesystem.delete_file(tmp)
                    except Exception:
                        pass
                    if attempt <= retries and wait_s > 0:
                        time.sleep(wait_s)
            return name, url, False, 0, retries + 1, error

        for pdf in batches:
            rows = [fetch_one(n, u) for n, u in zip(pdf["file_name"], pdf["url"])]
            yield pd.DataFrame(rows, columns=["file_name", "url", "ok", "bytes", "attempts", "error"])

    return run


FILES_PER_TASK = 4


def fetch_files(plan: DataFrame, dest: str, n: int, retries: int = 10, wait_s: float = 5.0,
                timeout_s: float = 60.0, tasks: int | None = None) -> DataFrame:
    """Lazy: one report row per planned file (at most ``n``). Materialise it
    once (it has side effects), e.g. with ``fetch_and_mark``."""
    tasks = tasks or max(1, -(-n // FILES_PER_TASK))
    spark = plan.sparkSession
    uri = shared_uri(spark, dest, shared_folders(spark))
    return plan.select("file_name", "url").repartition(tasks).mapInPandas(
        _fetcher(uri, retries, wait_s, timeout_s), FETCH_SCHEMA)


def shared_uri(spark: SparkSession, dest: str, shared: Sequence[str] = ()) -> str:
    """The destination as a URI for ``pyarrow.fs`` that means the same folder
    to every executor and to Spark's readers. Folders at and below ``shared``
    do so on a cluster too, whatever their scheme."""
    uri = qualified(spark, dest)
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        mounted = any(f"{uri}/".startswith(qualified(spark, folder).rstrip("/") + "/") for folder in shared)
        if not mounted and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{uri} is on each machine's own disk; give a folder that all executors share, "
                             "in a store or below spark.checkpoint.dir")
        return "file:///" + rest.lstrip("/")
    return f"s3:{rest}" if scheme in ("s3a", "s3n") else uri


def fetch_and_mark(spark: SparkSession, url_list: str, ledger: LinkTable | str, n: int, dest: str,
                   report: LinkTable | str, **fetch_kw) -> DataFrame:
    """Fetch until ``n`` files arrived or no file is left to try; mark the
    files that arrived. Returns the report rows of this run.

    Only arrivals count towards ``n``: each round plans the shortfall from
    files not yet marked and not yet tried in this run (an anti join with the
    report table), fetches them in parallel, records the outcome and marks the
    arrivals. Every round removes what it tried from the candidates, so the
    rounds end.
    """
    ledger, report = as_table(ledger), as_table(report)
    run = uuid.uuid4().hex[:12]
    urls = read_lines(spark, url_list)
    arrived, round_no = 0, 0
    while arrived < n:
        round_no += 1
        done = read_ledger(spark, ledger)
        if round_no > 1:
            tried = read_table(spark, report).where(F.col("fetch_run") == run)
            done = done.unionByName(tried.select("file_name"))
        plan = download_plan(urls, done, n - arrived)
        outcome = (fetch_files(plan, dest, n - arrived, **fetch_kw)
                   .withColumn("fetch_run", F.lit(run)).withColumn("fetch_round", F.lit(round_no)))
        append_table(outcome, report)
        this_round = read_table(spark, report).where(
            (F.col("fetch_run") == run) & (F.col("fetch_round") == round_no))
        counts = this_round.groupBy("ok").count().collect()  # at most two rows
        if not counts:
            break
        mark_processed(this_round.where("ok"), ledger)
        arrived += sum(r["count"] for r in counts if r.ok)
    return read_table(spark, report).where(F.col("fetch_run") == run)
