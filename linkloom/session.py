"""One session builder and the shared work folder.

Crawl metadata carries both ``Content-Type`` and ``content-type`` headers; a
case-insensitive session refuses such records when it infers their schema.
The library reads with a fixed schema, so it works in any session; case
sensitivity is still the default here (as in the original jobs) for users
who infer. Nothing here hard-codes a cluster path; scratch output goes below
the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the library wants unless the launcher (spark-submit,
# spark-defaults.conf) or the caller already chose a value.
DEFAULT_SQL_CONF = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A generated method above 8000 bytes of bytecode is never JIT-compiled
    # and runs interpreted; above this limit Spark falls back to per-operator
    # code instead, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings fixed when the context starts (used only when this builder starts it).
DEFAULT_STATIC_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Gzip crawl files are not splittable: one file is one task, so the
    # scheduler should not wait for locality on a busy cluster.
    "spark.locality.wait": "0s",
}

DEFAULT_CONF = {**DEFAULT_SQL_CONF, **DEFAULT_STATIC_CONF}


def build_session(app_name: str = "linkloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with the library settings.

    ``master`` is only applied when given (tests, bench); on a cluster the
    launcher decides it. Settings in ``conf`` always apply; the library's
    SQL defaults apply only to keys the launcher did not set.
    """
    conf = dict(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_unset_by_launcher(DEFAULT_STATIC_CONF), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    launched = spark.sparkContext.getConf()
    for key, value in DEFAULT_SQL_CONF.items():
        if key not in conf and not launched.contains(key):
            spark.conf.set(key, value)
    size_shuffles(spark, conf)
    return spark


def _unset_by_launcher(defaults: dict[str, str]) -> dict[str, str]:
    """The defaults whose keys the launcher (spark-submit options,
    PYSPARK_SUBMIT_ARGS, spark-defaults.conf) did not set. The JVM knows what
    the launcher gave as soon as it runs."""
    from pyspark import SparkConf, SparkContext

    SparkContext._ensure_initialized()
    launched = SparkConf(loadDefaults=True)
    return {k: v for k, v in defaults.items() if not launched.contains(k)}


SHUFFLE_KEYS = ("spark.sql.shuffle.partitions",
                "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def size_shuffles(spark: SparkSession, conf: dict[str, str] | None = None,
                  partitions: int = 2_000) -> None:
    """Start shuffles with enough partitions for a large one, unless the
    launcher or caller sized them.

    AQE only merges shuffle partitions (to its advisory size), it never
    splits an ordinary one, so the initial count must be large enough for
    the biggest shuffle; small shuffles are merged back down at run time. The
    number does not depend on how many executors have joined so far. A local
    session keeps Spark's own number.
    """
    conf = conf or {}
    launched = spark.sparkContext.getConf()
    if any(key in conf or launched.contains(key) for key in SHUFFLE_KEYS):
        return
    if not spark.sparkContext.master.startswith("local"):
        spark.conf.set(SHUFFLE_KEYS[1], str(partitions))


def shared_folders(spark: SparkSession) -> list[str]:
    """The folders that the deployment names as the same on every machine:
    ``spark.checkpoint.dir`` and the session's own folder in it (none if unset)."""
    named = (spark.sparkContext.getCheckpointDir(), spark.conf.get("spark.checkpoint.dir", None))
    return [folder for folder in named if folder]


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be a shared file
    system; without it there is no folder that all executors see, which is an
    error. Only a session on one machine (local runs and tests) makes its own
    and registers it, so that ``DataFrame.checkpoint()`` works too.
    """
    sc = spark.sparkContext
    root = next(iter(shared_folders(spark)), None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="linkloom-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the checkpoint root.

    Every run takes its own folder so that nothing has to be deleted and
    reruns never see another run's files.
    """
    root = checkpoint_root(spark)
    return join_path(root, f"linkloom-{label}-{uuid.uuid4().hex[:12]}")


def join_path(base: str, *parts: str) -> str:
    """Join path parts for local paths and URIs alike (``hdfs://``, ``s3a://``)."""
    out = base.rstrip("/")
    for part in parts:
        out = f"{out}/{part.strip('/')}"
    return out


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can inspect a local path (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
