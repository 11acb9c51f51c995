"""Distributed fetch of planned files (the download jobs), offline via file:// urls."""

from __future__ import annotations

import io
import os

import pytest
from conftest import rows

from linkloom.operators.ledger import read_ledger
from linkloom.plans.fetch import fetch_and_mark
from linkloom.tables import LinkTable


def test_fetch_marks_only_arrived_files(spark, work):
    src = os.path.join(work, "remote")
    os.makedirs(src)
    for i in range(5):
        with open(os.path.join(src, f"f{i}.warc.wat.gz"), "wb") as fh:
            fh.write(bytes([i]) * (1000 + i))
    lists = os.path.join(work, "lists")
    os.makedirs(lists)
    urls = [f"file://{src}/f{i}.warc.wat.gz" for i in range(5)] + [f"file://{src}/missing.warc.wat.gz"]
    with open(os.path.join(lists, "part-0.csv"), "w") as fh:
        fh.write("\n".join(urls) + "\n")
    ledger, report = LinkTable(os.path.join(work, "ledger")), LinkTable(os.path.join(work, "report"))
    dest = os.path.join(work, "dest")

    first = fetch_and_mark(spark, lists, ledger, 3, dest, report, retries=1, wait_s=0)
    assert rows(first, "file_name", "ok", "bytes") == [
        ("f0.warc.wat.gz", True, 1000), ("f1.warc.wat.gz", True, 1001), ("f2.warc.wat.gz", True, 1002)]
    assert sorted(f for f in os.listdir(dest) if not f.startswith(".")) == [
        "f0.warc.wat.gz", "f1.warc.wat.gz", "f2.warc.wat.gz"]

    second = fetch_and_mark(spark, lists, ledger, 10, dest, report, retries=1, wait_s=0)
    got = {r.file_name: (r.ok, r.attempts) for r in second.collect()}
    assert got["missing.warc.wat.gz"] == (False, 2)  # failed after the retry: not marked
    assert got["f3.warc.wat.gz"][0] and got["f4.warc.wat.gz"][0]
    assert sorted(r.file_name for r in read_ledger(spark, ledger).collect()) == [
        f"f{i}.warc.wat.gz" for i in range(5)]
    with open(os.path.join(dest, "f4.warc.wat.gz"), "rb") as fh:
        assert fh.read() == bytes([4]) * 1004
    # The failed file stays pending for the next run.
    third = fetch_and_mark(spark, lists, ledger, 10, dest, report, retries=0, wait_s=0)
    assert [r.file_name for r in third.collect()] == ["missing.warc.wat.gz"]


def test_failures_are_replaced_within_the_run(spark, work):
    src = os.path.join(work, "remote")
    os.makedirs(src)
    for name in ("b.gz", "c.gz", "d.gz"):
        with open(os.path.join(src, name), "wb") as fh:
            fh.write(b"1")
    lists = os.path.join(work, "lists")
    os.makedirs(lists)
    with open(os.path.join(lists, "l.txt"), "w") as fh:  # the missing file sorts first
        fh.write("\n".join(f"file://{src}/{n}" for n in ("a_missing.gz", "b.gz", "c.gz", "d.gz")) + "\n")
    ledger, report = LinkTable(os.path.join(work, "ledger")), LinkTable(os.path.join(work, "report"))
    out = fetch_and_mark(spark, lists, ledger, 2, os.path.join(work, "dest"), report, retries=0, wait_s=0)
    got = sorted((r.file_name, r.ok, r.fetch_round) for r in out.collect())
    assert got == [("a_missing.gz", False, 1), ("b.gz", True, 1), ("c.gz", True, 2)]
    assert sorted(r.file_name for r in read_ledger(spark, ledger).collect()) == ["b.gz", "c.gz"]


class Response(io.BytesIO):
    """What ``urlopen`` gives for a web address."""

    def __init__(self, body, status=200, announced=None):
        super().__init__(body)
        self.status = status
        self.headers = {} if announced is None else {"Content-Length": str(announced)}


@pytest.mark.parametrize("response, ok, error", [
    (dict(body=b"12345", announced=5), True, None),
    (dict(body=b"12345"), True, None),
    (dict(body=b"123", announced=5), False, "3 of 5 bytes came"),
    (dict(body=b"12345", announced=5, status=206), False, "status 206"),
])
def test_a_file_has_arrived_when_it_is_whole(work, monkeypatch, response, ok, error):
    import urllib.request

    import pandas as pd

    from linkloom.plans.fetch import _fetcher
    monkeypatch.setattr(urllib.request, "urlopen", lambda *a, **k: Response(**response))
    plan = pd.DataFrame([("f.gz", "https://h/f.gz")], columns=["file_name", "url"])
    out = next(_fetcher(f"file://{work}", 1, 0, 1.0)(iter([plan]))).iloc[0]
    assert bool(out.ok) is ok
    assert (out.error is None) if error is None else error in out.error
    assert [f for f in os.listdir(work) if f.endswith(".gz")] == (["f.gz"] if ok else [])


def test_destination_is_one_folder_for_all(spark, monkeypatch):
    from linkloom.plans import fetch
    assert fetch.shared_uri(spark, "/tmp/x").startswith("file:///tmp/x")

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

    for uri, want in (("s3a://b/k", "s3://b/k"), ("hdfs://n/k", "hdfs://n/k"), ("file:/tmp/x", None)):
        monkeypatch.setattr(fetch, "qualified", lambda *_, uri=uri: uri)
        if want:
            assert fetch.shared_uri(Cluster, uri) == want
        else:
            with pytest.raises(ValueError, match="own disk"):
                fetch.shared_uri(Cluster, uri)


def test_the_checkpoint_folder_is_shared_on_a_cluster(spark, work, monkeypatch):
    """A cluster whose ``spark.checkpoint.dir`` is a mounted ``file:`` folder."""
    from linkloom.plans.fetch import shared_uri
    from linkloom.session import shared_folders

    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    shared = shared_folders(spark)
    assert shared_uri(spark, os.path.join(work, "dest"), shared) == f"file://{work}/dest"
    assert shared_uri(spark, shared[0], shared).startswith("file:///")
    for dest in ("/tmp/x", shared[-1].rstrip("/") + "2/x", os.path.join(work, "../../../x")):
        with pytest.raises(ValueError, match="own disk"):
            shared_uri(spark, dest, shared)


def test_fetch_ingest_on_a_cluster(spark, duck, monkeypatch):
    """The query's folders lie below the checkpoint folder, so it runs there."""
    from conftest import SF_SMALL

    from linkloom.plans import oracle, registry
    from linkloom.session import checkpoint_root

    checkpoint_root(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    got = registry.queries()["fetch_ingest"](spark, SF_SMALL)
    want = duck().execute(f"SELECT {', '.join(got.columns)} FROM ({oracle.WAT_LINKS})").fetchall()
    assert want and rows(got) == sorted(want, key=repr)
