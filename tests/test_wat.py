"""Crawl-metadata reader (SRC1, PRJ1-3, PRJ6, S1) and the derived WAT files."""

from __future__ import annotations

import gzip
import json
import os

from conftest import SF_SMALL, rows

from linkloom.sources.derived import page_links, write_wat_files
from linkloom.sources.wat import read_wat_links


def record(links, headers=None):
    response = {"Headers": headers or {"Content-Type": "text/html"},
                "HTML-Metadata": {"Head": {"Title": "t"}, "Links": links}}
    return json.dumps({"Envelope": {"Format": "WARC",
                                    "Payload-Metadata": {"HTTP-Response-Metadata": response}}})


def write_gz(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


HEADER = ["WARC/1.0", "WARC-Type: metadata", ""]


def test_links_with_all_edge_records(spark, work):
    lines = HEADER + [
        "this is not json",
        json.dumps({"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {}}}}),  # no HTML-Metadata
        json.dumps({"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {
            "HTML-Metadata": {"Links": None}}}}}),
        record([]),
        record([{"path": "A@/href", "url": "http://a.jp/x.jpg", "text": "x"}]),  # no title, no target
        record([{"path": "IMG@/src", "url": "//b.kr/i.png", "title": 7}]),  # non-string title
        record([{"path": "A@/href", "url": "u1", "target": "_blank", "title": "T"},
                {"path": "A@/href", "url": "u2"}],
               headers={"Content-Type": "text/html", "content-type": "text/html"}),
        '{"Envelope": {"Payload-Metadata": ',  # cut-off line
    ]
    write_gz(os.path.join(work, "f1.warc.wat.gz"), lines)
    got = rows(read_wat_links(spark, work))
    assert got == sorted([
        ("A@/href", None, "x", None, "http://a.jp/x.jpg"),
        ("IMG@/src", None, None, "7", "//b.kr/i.png"),
        ("A@/href", "_blank", None, "T", "u1"),
        ("A@/href", None, None, None, "u2"),
    ], key=repr)


def test_all_junk_file_gives_no_rows(spark, work):
    write_gz(os.path.join(work, "junk.warc.wat.gz"), HEADER + ["not json", "{", ""])
    df = read_wat_links(spark, work)
    assert df.columns == ["path", "target", "text", "title", "url"]
    assert df.count() == 0


def test_multi_path_read_and_source_name(spark, work):
    a, b = os.path.join(work, "a.wat.gz"), os.path.join(work, "b.wat.gz")
    write_gz(a, HEADER + [record([{"url": "ua"}])])
    write_gz(b, HEADER + [record([{"url": "ub1"}, {"url": "ub2"}])])
    got = rows(read_wat_links(spark, [a, b], with_source=True), "file_name", "url")
    assert got == [("a.wat.gz", "ua"), ("b.wat.gz", "ub1"), ("b.wat.gz", "ub2")]


def test_written_wat_files_read_back_as_page_links(spark, work):
    folder = write_wat_files(spark, SF_SMALL, os.path.join(work, "wat"), pages_per_file=10)
    files = [f for f in os.listdir(folder) if f.endswith(".gz")]
    assert len(files) >= 2
    back = read_wat_links(spark, folder)
    expected = page_links(spark, SF_SMALL)
    assert rows(back, "url", "text") == rows(expected, "url", "text")
    assert {r.path for r in back.select("path").distinct().collect()} == {"A@/href"}


def test_fixed_schema_scan_prunes_to_links(spark, work):
    write_gz(os.path.join(work, "p.wat.gz"), HEADER + [record([{"url": "u"}])])
    plan = read_wat_links(spark, work).select("url")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "FileScan json" in plan


def test_fixed_schema_reads_both_header_spellings_in_any_session(spark, work):
    write_gz(os.path.join(work, "h.gz"), HEADER + [record(
        [{"url": "u"}], headers={"Content-Type": "a", "content-type": "b"})])
    before = spark.conf.get("spark.sql.caseSensitive")
    try:
        spark.conf.set("spark.sql.caseSensitive", "false")
        assert rows(read_wat_links(spark, work), "url") == [("u",)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

FIELD_VALUE = st.one_of(st.text(alphabet="ab/.:?é ", max_size=6), st.integers(0, 9), st.none())
LINK = st.dictionaries(st.sampled_from(["path", "target", "text", "title", "url"]), FIELD_VALUE,
                       max_size=5)
RECORD = st.one_of(
    st.lists(LINK, max_size=4).map(lambda links: ("links", links)),
    st.just(("junk", None)), st.just(("null_links", None)), st.just(("no_html", None)))


def json_text(value):
    """How a link field arrives: strings as they are, numbers as JSON text."""
    if value is None:
        return None
    return value if isinstance(value, str) else json.dumps(value)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(RECORD, min_size=1, max_size=12))
def test_property_reader_matches_model(spark, records):
    from linkloom.session import local_path, new_work_dir
    folder = local_path(new_work_dir(spark, "watprop"))
    os.makedirs(folder)
    lines, expected = list(HEADER), []
    for kind, links in records:
        if kind == "links":
            lines.append(record(links))
            expected += [tuple(json_text(link.get(f)) for f in ("path", "target", "text", "title", "url"))
                         for link in links]
        elif kind == "junk":
            lines.append("WARC-Type: metadata")
        elif kind == "null_links":
            lines.append(json.dumps({"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {
                "HTML-Metadata": {"Links": None}}}}}))
        else:
            lines.append(json.dumps({"Envelope": {"Payload-Metadata": {}}}))
    write_gz(os.path.join(folder, "p.gz"), lines)
    assert rows(read_wat_links(spark, folder)) == sorted(expected, key=repr)
