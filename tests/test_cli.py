"""The command-line jobs, end to end on small hand-made inputs."""

from __future__ import annotations

import gzip
import json
import os

from linkloom.cli import main
from linkloom.sources.files import read_lines


def wat(path, urls):
    rec = {"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {"HTML-Metadata": {
        "Links": [{"path": "A@/href", "url": u} for u in urls]}}}}}
    with gzip.open(path, "wt") as fh:
        fh.write("WARC/1.0\n\n" + json.dumps(rec) + "\n")


def test_jobs_end_to_end(spark, work, capsys):
    j = lambda *p: os.path.join(work, *p)
    with open(j("list.csv"), "w") as fh:
        fh.write("warc_filename\ncrawl-data/S/segments/1/warc/A.warc.gz\ncrawl-data/S/segments/1/warc/B.warc.gz\n")
    assert main(["warc-to-wat", "--csv", j("list.csv"), "--out", j("wat_list"),
                 "--warc-table", j("warc_t"), "--wat-table", j("wat_t")]) == 0
    lines = sorted(r.value for r in read_lines(spark, j("wat_list")).collect())
    assert lines[0].endswith("/wat/A.warc.wat.gz")

    os.makedirs(j("done_urls"))
    with open(j("done_urls", "x.txt"), "w") as fh:
        fh.write(lines[0] + "\n")
    main(["mark-done", "--names", j("done_urls"), "--ledger", j("fetch_ledger")])
    main(["plan-downloads", "5", "--url-list", j("wat_list"), "--ledger", j("fetch_ledger")])
    assert capsys.readouterr().out.split() == [lines[1]]

    os.makedirs(j("wat"))
    wat(j("wat", "f1.gz"), ["http://a.jp/x.jpg", "http://a.jp/y.png", "http://k.co.kr/z.jpg"])
    wat(j("wat", "f2.gz"), ["http://a.jp/x.jpg"])
    main(["ingest", "--wat", j("wat"), "--ledger", j("ledger"), "--raw", j("raw")])
    main(["ingest", "--wat", j("wat"), "--ledger", j("ledger"), "--raw", j("raw")])
    assert "ingested 2 file(s)" in capsys.readouterr().out
    assert spark.read.parquet(j("raw")).count() == 4

    main(["extract", "jpg-jpeg", "--raw", j("raw"), "--out", j("jpg")])
    main(["extract", "png", "--raw", j("raw"), "--out", j("png")])
    main(["dedup", "--src", j("jpg"), "--dst", j("jpg_distinct"), "--order-by", "path", "--skip-existing"])
    assert spark.read.parquet(j("jpg")).count() == 2
    assert spark.read.parquet(j("jpg_distinct")).count() == 1
    main(["export", "--table", j("jpg_distinct"), "--out", j("export")])
    assert read_lines(spark, j("export")).count() == 1

    main(["stream", "st6", "--base", j("single"), "--raw", j("raw"), "--once"])
    main(["stream", "fan-in", "--base", j("tables"), "--raw", j("raw"), "--once"])
    assert spark.read.parquet(j("single", "kr_http_links", "job=st6")).count() == 1
    assert spark.read.parquet(j("tables", "kr_http_links", "job=fan_in")).count() == 1

    main(["audit", "--table", j("raw")])
    out = capsys.readouterr().out
    assert "##### Count 4" in out and "url: string" in out
    main(["range-smoke", "--out", j("range")])
    assert spark.read.parquet(j("range")).count() == 5


def test_download_job(spark, work, capsys):
    src = os.path.join(work, "remote")
    os.makedirs(src)
    with open(os.path.join(src, "w1.gz"), "wb") as fh:
        fh.write(b"x" * 10)
    os.makedirs(os.path.join(work, "list"))
    with open(os.path.join(work, "list", "p.txt"), "w") as fh:
        fh.write(f"file://{src}/w1.gz\n")
    main(["download", "5", "--url-list", os.path.join(work, "list"), "--ledger", os.path.join(work, "l"),
          "--dest", os.path.join(work, "dest"), "--report", os.path.join(work, "r"), "--wait", "0"])
    assert "Number of files downloaded 1" in capsys.readouterr().out
    assert os.path.exists(os.path.join(work, "dest", "w1.gz"))


def test_warc_to_wat_into_catalog_tables(spark, work):
    csv = os.path.join(work, "l.csv")
    with open(csv, "w") as fh:
        fh.write("warc_filename\ncrawl-data/S/segments/9/warc/Z.warc.gz\n")
    main(["warc-to-wat", "--csv", csv, "--out", os.path.join(work, "out"), "--create-database", "linkloom_raw",
          "--warc-table", "catalog:linkloom_raw.warc_names", "--wat-table", "catalog:linkloom_raw.wat_names"])
    assert spark.table("linkloom_raw.wat_names").first().full_wat_path.endswith("/wat/Z.warc.wat.gz")


def test_ingest_stream_job(spark, work):
    src = os.path.join(work, "wat")
    os.makedirs(src)
    for i in range(3):
        wat(os.path.join(src, f"s{i}.gz"), [f"http://a.jp/{i}.jpg"])
    args = ["ingest-stream", "--wat", src, "--raw", os.path.join(work, "raw"),
            "--checkpoint", os.path.join(work, "ck"), "--archive", os.path.join(work, "arch"),
            "--max-files", "1", "--once"]
    assert main(args) == 0
    assert main(args) == 0  # nothing new: nothing added
    assert spark.read.parquet(os.path.join(work, "raw", "job=ingest")).count() == 3
    archived = [f for _, _, fs in os.walk(os.path.join(work, "arch")) for f in fs if f.endswith(".gz")]
    assert archived
