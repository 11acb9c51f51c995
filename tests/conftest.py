from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from linkloom.session import build_session

    # spark.checkpoint.dir is not set here: work folders go below the one the
    # environment names, and the library makes its own only when none is set.
    scratch = tempfile.mkdtemp(prefix="linkloom-tests-")
    session = build_session("linkloom-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def work(spark):
    """A fresh folder below the session's checkpoint root."""
    from linkloom.session import local_path, new_work_dir

    path = local_path(new_work_dir(spark, "t"))
    os.makedirs(path, exist_ok=True)
    return path


@pytest.fixture(scope="session")
def duck():
    import duckdb

    cons = {}

    def get(sf_dir: str = SF_SMALL):
        if sf_dir not in cons:
            con = duckdb.connect()
            for t in TABLES:
                p = os.path.join(sf_dir, f"{t}.parquet")
                if os.path.exists(p):
                    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
            cons[sf_dir] = con
        return cons[sf_dir]

    return get


def rows(df, *cols):
    """Sorted tuples of a DataFrame (or of the named columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"
