"""Streaming jobs: admission rate (STF2), restart (STF1), chaining, fan-in
(FAN1), ingest by base name (STF3) and archiving consumed files (SNK10)."""

from __future__ import annotations

import gzip
import json
import os

import pytest
from conftest import SF_SMALL, rows

from linkloom.functions.rules import KR_FAN_IN
from linkloom.operators.fanin import tag_rules
from linkloom.sources.derived import synthetic_links
from linkloom.streaming.fanin import run_fan_in
from linkloom.streaming.ingest import read_raw, run_ingest_stream, start_ingest_stream
from linkloom.streaming.jobs import SPECS, STREAMS, StreamLayout, read_table_batch, run_stream, start_stream
from linkloom.streaming.queries import write_raw_links


def layout_at(work):
    return StreamLayout(base=os.path.join(work, "tables"), checkpoints=os.path.join(work, "ckpt"))


def add_raw_file(spark, layout, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1)
    df.write.mode("append").parquet(layout.raw())


def sink_urls(spark, layout, spec):
    return rows(spark.read.parquet(layout.job_folder(spec)), "url")


def test_rate_restart_and_new_file(spark, work):
    layout = layout_at(work)
    for i in range(3):
        add_raw_file(spark, layout, [f"http://a{i}.jp/x", f"http://b{i}.kr/y"])
    spec = SPECS["st1"]
    query = start_stream(spark, spec, layout)
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3  # one file per batch
    assert sink_urls(spark, layout, spec) == [(f"http://a{i}.jp/x",) for i in range(3)]
    run_stream(spark, spec, layout)  # nothing new: adds nothing
    assert len(sink_urls(spark, layout, spec)) == 3
    add_raw_file(spark, layout, ["http://c.jp/z", "http://d.com/"])
    run_stream(spark, spec, layout)
    assert len(sink_urls(spark, layout, spec)) == 4


def test_chain_jp_jpg(spark, work):
    layout = layout_at(work)
    add_raw_file(spark, layout, ["http://a.jp/x.jpg", "HTTP://B.JP/Y.JPG", "http://a.jp/x.png",
                                 "//c.jp/z.jpg", "http://d.kr/x.jpg", None])
    run_stream(spark, "st2", layout)  # runs st1 first
    assert sink_urls(spark, layout, SPECS["st2"]) == [("HTTP://B.JP/Y.JPG",), ("http://a.jp/x.jpg",)]


def test_kr_chain_keeps_duplicates_of_two_rules(spark, work):
    layout = layout_at(work)
    add_raw_file(spark, layout, ["http://x.co.kr/a.joins.com/i.jpg", "http://m.daum.net/p.jpg",
                                 "http://m.naver.com/p.jpg"])
    run_stream(spark, "st7", layout)
    assert sorted(n for n in os.listdir(os.path.join(layout.base, "kr_http_links")) if "=" in n) == ["job=fan_in"]
    table = rows(read_table_batch(spark, layout, "kr_http_links"), "url")
    assert table.count(("http://x.co.kr/a.joins.com/i.jpg",)) == 2
    assert sink_urls(spark, layout, SPECS["st7"]) == sorted(
        [("http://x.co.kr/a.joins.com/i.jpg",)] * 2 + [("http://m.daum.net/p.jpg",)])


@pytest.mark.parametrize("name", [s.name for s in STREAMS if s.source == "raw"])
def test_stream_equals_batch(spark, work, name):
    layout = layout_at(work)
    write_raw_links(spark, SF_SMALL, layout.raw(), n_files=3)
    spec = SPECS[name]
    run_stream(spark, spec, layout, max_files=2)
    batch = spec.transform(spark.read.parquet(layout.raw()))
    assert sink_urls(spark, layout, spec) == rows(batch, "url")


def test_fan_in_stream_equals_batch(spark, work):
    layout = layout_at(work)
    write_raw_links(spark, SF_SMALL, layout.raw(), n_files=2)
    sink = os.path.join(work, "fan")
    run_fan_in(spark, layout, sink, os.path.join(work, "ckpt_fan"), max_files=2)
    stream = rows(spark.read.parquet(sink), "rule", "url")
    batch = rows(tag_rules(synthetic_links(spark, SF_SMALL), KR_FAN_IN), "rule", "url")
    assert stream == batch
    batches = os.path.join(sink, "job=fan_in")
    assert sorted(os.listdir(batches)) == ["batch=0"]  # both files
    assert {d for d in os.listdir(os.path.join(batches, "batch=0")) if d.startswith("rule=")} \
        == {f"rule={r.name}" for r in KR_FAN_IN}


def wat(path, urls):
    rec = {"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {"HTML-Metadata": {
        "Links": [{"url": u} for u in urls]}}}}}
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as fh:
        fh.write("WARC/1.0\n\n" + json.dumps(rec) + "\n")


def test_ingest_stream_once_per_base_name(spark, work):
    src = os.path.join(work, "wat")
    wat(os.path.join(src, "d1", "a.gz"), ["u1", "u2"])
    wat(os.path.join(src, "d1", "b.gz"), ["u3"])
    raw, ckpt = os.path.join(work, "raw"), os.path.join(work, "ckpt")
    run_ingest_stream(spark, os.path.join(src, "*", "*.gz"), raw, ckpt)
    assert rows(read_raw(spark, raw), "url") == [("u1",), ("u2",), ("u3",)]
    wat(os.path.join(src, "d2", "a.gz"), ["other"])  # same base name, other folder: skipped
    wat(os.path.join(src, "d2", "c.gz"), ["u4"])
    run_ingest_stream(spark, os.path.join(src, "*", "*.gz"), raw, ckpt)
    assert rows(read_raw(spark, raw), "url") == [("u1",), ("u2",), ("u3",), ("u4",)]


def test_ingest_stream_archives_consumed_files(spark, work):
    src, archive = os.path.join(work, "in"), os.path.join(work, "archive")
    for i in range(3):
        wat(os.path.join(src, f"f{i}.gz"), [f"u{i}"])
    q = start_ingest_stream(spark, src, os.path.join(work, "raw"), os.path.join(work, "ckpt"),
                            max_files=1, archive_dir=archive)
    q.awaitTermination()
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".gz")]
    assert 1 <= len(archived) <= 3
    assert read_raw(spark, os.path.join(work, "raw")).count() == 3


def test_stream_specs_table():
    assert [s.name for s in STREAMS] == [f"st{i}" for i in range(1, 13)]
    assert {s.max_files for s in STREAMS if s.name in ("st2", "st7")} == {4}
    assert sum(1 for s in STREAMS if s.sink == "kr_http_links") == 6


def test_rates():
    from linkloom.streaming.sources import AUTO, FILES_PER_BATCH, resolve_rate
    assert resolve_rate(None, SPECS["st1"].max_files) == 1
    assert resolve_rate(None, SPECS["st7"].max_files) == 4
    assert resolve_rate(AUTO, 1) == FILES_PER_BATCH and resolve_rate("3", 1) == 3


def test_st7_reads_the_feeders_that_exist(spark, work):
    layout = layout_at(work)
    add_raw_file(spark, layout, ["http://x.co.kr/a.jpg", "http://m.daum.net/p.jpg"])
    with pytest.raises(FileNotFoundError):
        run_stream(spark, "st7", layout, with_upstream=False)
    run_stream(spark, "st6", layout)
    run_stream(spark, "st7", layout, with_upstream=False)
    assert sink_urls(spark, layout, SPECS["st7"]) == [("http://x.co.kr/a.jpg",)]
    run_stream(spark, "st10", layout)  # a second feeder appears: its links come too
    run_stream(spark, "st7", layout, with_upstream=False)
    assert sink_urls(spark, layout, SPECS["st7"]) == [("http://m.daum.net/p.jpg",), ("http://x.co.kr/a.jpg",)]


def test_a_table_is_fed_one_way(spark, work):
    from linkloom.streaming.jobs import feed_table
    layout = layout_at(work)
    add_raw_file(spark, layout, ["http://x.co.kr/a.jpg"])
    feed_table(spark, layout, "kr_http_links")
    with pytest.raises(RuntimeError, match="fan-in"):
        run_stream(spark, "st6", layout)
    assert read_table_batch(spark, layout, "kr_http_links").count() == 1
    other = layout_at(os.path.join(work, "other"))
    add_raw_file(spark, other, ["http://x.co.kr/a.jpg"])
    run_stream(spark, "st6", other)
    with pytest.raises(RuntimeError, match="fan-in"):
        feed_table(spark, other, "kr_http_links")


def test_a_job_keeps_its_checkpoint(spark, work):
    """A foreign checkpoint is refused for a job and for the fan-in; before
    that nothing is written, so no link is lost or doubled."""
    from linkloom.streaming.jobs import feed_table
    layout = layout_at(work)
    add_raw_file(spark, layout, ["http://x.co.kr/a.jpg", "http://a.jp/b"])
    feed_table(spark, layout, "kr_http_links")
    run_stream(spark, "st1", layout)
    other = StreamLayout(base=layout.base, checkpoints=os.path.join(work, "elsewhere"))
    for start in (lambda: feed_table(spark, other, "kr_http_links"), lambda: run_stream(spark, "st1", other)):
        with pytest.raises(RuntimeError, match="belongs to checkpoint"):
            start()
    assert read_table_batch(spark, layout, "kr_http_links").count() == 1
    assert sink_urls(spark, layout, SPECS["st1"]) == [("http://a.jp/b",)]


def test_a_folder_of_another_writer_is_refused(spark, work):
    layout = layout_at(work)
    add_raw_file(spark, layout, ["http://a.jp/b"])
    spark.range(1).write.parquet(os.path.join(layout.base, "jp_http_links"))
    with pytest.raises(RuntimeError, match="another writer"):
        run_stream(spark, "st1", layout)


def test_single_jobs_share_a_table_in_any_order(spark, work):
    """Every job of the table, with new files between and in another order; a
    reader downstream takes four files a batch whatever the number of jobs."""
    layout = layout_at(work)
    sites = ["http://s.kr/{}.jpg", "http://s.joins.com/{}.jpg", "http://s.musinsa.com/{}.jpg",
             "http://s.daum.net/{}.jpg", "http://s.nate.com/{}.jpg", "http://s.chosun.com/{}.jpg"]
    jobs = layout.writers("kr_http_links")
    for i, order in enumerate((jobs, jobs[::-1])):
        add_raw_file(spark, layout, [s.format(i) for s in sites])
        for spec in order:
            run_stream(spark, spec, layout)
    want = sorted((s.format(i),) for s in sites for i in range(2))
    assert rows(read_table_batch(spark, layout, "kr_http_links"), "url") == want
    query = start_stream(spark, SPECS["st7"], layout)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"] > 0] == [4, 4, 4]
    assert sink_urls(spark, layout, SPECS["st7"]) == want


def test_a_batch_replayed_after_a_crash_is_there_once(spark, work, monkeypatch):
    """The driver is lost before the batch is published, then after it, before
    the checkpoint knows."""
    import shutil

    import linkloom.sinks.tables as tables
    layout = layout_at(work)
    add_raw_file(spark, layout, ["http://a.jp/b"])
    spec, real = SPECS["st1"], tables.move_folder
    monkeypatch.setattr(tables, "move_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        run_stream(spark, spec, layout)
    monkeypatch.setattr(tables, "move_folder", real)
    run_stream(spark, spec, layout)
    folder = os.path.join(layout.job_folder(spec), "batch=0")
    before = sorted(os.listdir(folder))
    shutil.rmtree(os.path.join(layout.checkpoint(spec), "commits"))
    run_stream(spark, spec, layout)
    assert sorted(os.listdir(folder)) == before  # a reader that saw the files sees no new ones
    assert sink_urls(spark, layout, spec) == [("http://a.jp/b",)]


def test_catalog_tables_as_source_and_sink(spark, work):
    from conftest import unique_name

    from linkloom.sinks.tables import create_database
    from linkloom.tables import LinkTable
    db = unique_name("linkloom_streams")
    create_database(spark, db)
    layout = StreamLayout(base=f"catalog:{db}", checkpoints=os.path.join(work, "c"))
    urls = ["http://s.kr/a.jpg", "http://m.daum.net/p.jpg", "http://b.kr/m.nate.com/x"]
    for i in range(2):
        spark.createDataFrame([(f"{u}{i}.jpg",) for u in urls], "url string").write.mode("append").saveAsTable(f"{db}.raw")
        run_stream(spark, "st7", layout)
    assert read_table_batch(spark, layout, "kr_http_links").count() == 8
    assert spark.table(f"{db}.kr_jpg_links").where("job = 'st7'").count() == 8
    other = StreamLayout(base=f"catalog:{db}", checkpoints=os.path.join(work, "other"))
    with pytest.raises(RuntimeError, match="belongs to checkpoint"):
        run_stream(spark, "st7", other, with_upstream=False)
    with pytest.raises(RuntimeError, match="fan-in"):
        run_stream(spark, "st6", layout)
    assert layout.table("kr_http_links") == LinkTable.catalog(f"{db}.kr_http_links")


def test_st7_rate_is_of_the_whole_batch(spark, work):
    layout = layout_at(work)
    write_raw_links(spark, SF_SMALL, layout.raw(), n_files=6)
    from linkloom.streaming.jobs import feed_table
    feed_table(spark, layout, "kr_http_links", max_files=1)
    n_files = sum(f.endswith(".parquet") for _, _, fs in os.walk(layout.fan_in_folder("kr_http_links"))
                  for f in fs)
    query = start_stream(spark, SPECS["st7"], layout)
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    assert n_files > 8 and len(batches) == -(-n_files // 4)


def test_ingest_streams_own_their_folders(spark, work):
    from linkloom.plans.ingest import ingest_wat_files
    from linkloom.streaming.ingest import read_raw
    from linkloom.tables import LinkTable
    raw = os.path.join(work, "raw")
    for name in ("jp", "kr"):
        wat(os.path.join(work, name, f"{name}.gz"), [f"http://{name}/"])
        run_ingest_stream(spark, os.path.join(work, name), raw, os.path.join(work, "c" + name), job=name)
    assert rows(read_raw(spark, raw), "url") == [("http://jp/",), ("http://kr/",)]
    with pytest.raises(RuntimeError, match="belongs to"):
        run_ingest_stream(spark, os.path.join(work, "jp"), raw, os.path.join(work, "other"), job="kr")
    with pytest.raises(RuntimeError, match="ingest streams"):
        ingest_wat_files(spark, os.path.join(work, "jp"), LinkTable(os.path.join(work, "l")), LinkTable(raw))
    layout = StreamLayout(base=os.path.join(work, "t"), checkpoints=os.path.join(work, "c"), raw_path=raw)
    assert read_table_batch(spark, layout, "raw").count() == 2


def test_ingest_stream_goes_on_without_bad_files(spark, work):
    from linkloom.streaming.ingest import read_stream_quarantine
    src, raw, ckpt = (os.path.join(work, n) for n in ("wat", "raw", "ckpt"))
    for name in ("a cut.gz", "b+%.gz"):
        wat(os.path.join(src, name), [f"u{i}" for i in range(300)])
        with open(os.path.join(src, name), "r+b") as fh:
            fh.truncate(150)
    run_ingest_stream(spark, src, raw, ckpt)
    wat(os.path.join(src, "c 1.gz"), ["u1"])
    wat(os.path.join(src, "d[2].gz"), ["u2"])
    with open(os.path.join(src, "e.gz"), "wb") as fh:
        fh.write(b"no gzip at all")
    run_ingest_stream(spark, src, raw, ckpt)
    run_ingest_stream(spark, src, raw, ckpt)
    assert rows(read_raw(spark, raw), "url") == [("u1",), ("u2",)]
    assert rows(read_stream_quarantine(spark, raw), "file_name") == [("a cut.gz",), ("b+%.gz",), ("e.gz",)]


def test_a_stream_sees_committed_runs_only(spark, work, monkeypatch):
    """A catalog write cut between partitions, and a path run before its commit
    row: no row of either is seen until the run is finished."""
    from conftest import unique_name

    import linkloom.plans.ingest as ingest
    from linkloom.sinks.tables import create_database
    from linkloom.tables import LinkTable
    db = unique_name("linkloom_committed")
    create_database(spark, db)
    src = os.path.join(work, "wat")
    wat(os.path.join(src, "r1.gz"), ["http://a.jp/1"])
    for raw in (LinkTable.catalog(f"{db}.raw"), LinkTable(os.path.join(work, "raw"))):
        place = os.path.join(work, "catalog" if raw.in_catalog else "path")
        ledger = LinkTable(os.path.join(place, "ledger"))
        ingest.ingest_wat_files(spark, src, ledger, raw)
        layout = StreamLayout(base=os.path.join(place, "t"), checkpoints=os.path.join(place, "c"), ledger=ledger,
                              raw_path=f"catalog:{raw}" if raw.in_catalog else raw.path)
        run_stream(spark, "st1", layout)
        wat(os.path.join(src, "r2.gz"), ["http://a.jp/2"])
        with monkeypatch.context() as m:  # the rows are there, the commit row is not
            m.setattr(ingest, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                ingest.ingest_wat_files(spark, src, ledger, raw)
        run_stream(spark, "st1", layout)
        assert rows(spark.read.parquet(layout.job_folder(SPECS["st1"])), "url") == [("http://a.jp/1",)]
        assert rows(ingest.read_committed(spark, raw, ledger), "url") == [("http://a.jp/1",)]
        assert rows(read_table_batch(spark, layout, "raw"), "url") == [("http://a.jp/1",)]
        ingest.ingest_wat_files(spark, src, ledger, raw)
        run_stream(spark, "st1", layout)
        assert sink_urls(spark, layout, SPECS["st1"]) == [("http://a.jp/1",), ("http://a.jp/2",)]
        os.remove(os.path.join(src, "r2.gz"))


def test_stream_follows_new_ingest_runs(spark, work):
    from linkloom.plans.ingest import ingest_wat_files
    from linkloom.tables import LinkTable
    src = os.path.join(work, "wat")
    wat(os.path.join(src, "r1.gz"), ["http://a.jp/1", "http://b.kr/1"])
    ledger, raw = LinkTable(os.path.join(work, "ledger")), os.path.join(work, "raw")
    ingest_wat_files(spark, src, ledger, LinkTable(raw))
    layout = StreamLayout(base=os.path.join(work, "t"), checkpoints=os.path.join(work, "c"), raw_path=raw)
    run_stream(spark, "st1", layout)
    assert sink_urls(spark, layout, SPECS["st1"]) == [("http://a.jp/1",)]
    wat(os.path.join(src, "r2.gz"), ["http://c.jp/2"])
    ingest_wat_files(spark, src, ledger, LinkTable(raw))
    run_stream(spark, "st1", layout)
    assert sink_urls(spark, layout, SPECS["st1"]) == [("http://a.jp/1",), ("http://c.jp/2",)]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

URL_PIECES = st.sampled_from(["http://", "https://", "//", "www.naver.com/", "a.co.jp/", "b.co.kr/",
                              "m.kakao.com/", "x.daum.net/", "x.nate.com/", "x.chosun.com/",
                              "x.joins.com/", "x.musinsa.com/", "p", ".jpg", ".JPEG", ".png", ".bmp",
                              "?w=1", "/"])
RAW_FED = [s for s in STREAMS if s.source == "raw"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(urls=st.lists(st.one_of(st.none(), st.lists(URL_PIECES, max_size=5).map("".join)),
                     min_size=1, max_size=40),
       spec=st.sampled_from(RAW_FED), n_files=st.integers(1, 3))
def test_property_stream_equals_batch(spark, urls, spec, n_files):
    from linkloom.session import local_path, new_work_dir
    work = local_path(new_work_dir(spark, "prop"))  # fresh for every example
    layout = StreamLayout(base=os.path.join(work, "t"), checkpoints=os.path.join(work, "c"))
    spark.createDataFrame([(u,) for u in urls], "url string").repartition(n_files) \
        .write.parquet(layout.raw())
    run_stream(spark, spec, layout)
    got = rows(spark.read.parquet(layout.job_folder(spec)), "url") \
        if os.path.exists(layout.job_folder(spec)) else []
    want = rows(spec.transform(spark.read.parquet(layout.raw())), "url")
    assert got == want
