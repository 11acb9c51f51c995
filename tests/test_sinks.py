"""Table sinks and sources: overwrite/append/create, exists probe, export
layout (S11, S13), line reader (SRC8), listing (SRC7), catalog (SRC5)."""

from __future__ import annotations

import os

import pytest
from conftest import rows, unique_name
from pyspark.errors import AnalysisException

from linkloom.sinks.tables import (append_table, create_database, create_new_table,
                                   create_or_append, export_delimited, overwrite_table)
from linkloom.sources.files import (list_files, read_catalog_table, read_csv_list, read_lines,
                                    read_range, read_table, table_exists)
from linkloom.tables import LinkTable


def urls(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def test_overwrite_append_create(spark, work):
    t = LinkTable(os.path.join(work, "t"))
    assert not table_exists(spark, t)
    assert create_or_append(urls(spark, ["a"]), t) is False
    assert create_or_append(urls(spark, ["b"]), t) is True
    append_table(urls(spark, ["b"]), t)
    assert rows(read_table(spark, t)) == [("a",), ("b",), ("b",)]
    overwrite_table(urls(spark, ["z"]), t)
    assert rows(read_table(spark, t)) == [("z",)]
    with pytest.raises(AnalysisException):
        create_new_table(urls(spark, ["y"]), t)
    create_new_table(read_range(spark, 0, 5), LinkTable(os.path.join(work, "range")))
    assert read_table(spark, os.path.join(work, "range")).count() == 5


def test_table_exists_rethrows_other_errors(spark, work):
    empty = os.path.join(work, "empty_dir")
    os.makedirs(empty)
    with pytest.raises(AnalysisException):
        table_exists(spark, empty)  # exists but holds no parquet: not "missing"
    assert table_exists(spark, os.path.join(work, "nope")) is False


def test_s11_export_quotes_and_nulls_and_no_header(spark, work):
    df = spark.createDataFrame([(1, "a|b"), (2, None), (3, ""), (4, 'q"x')], "k int, v string")
    out = os.path.join(work, "exp")
    export_delimited(df, out)
    lines = sorted(r.value for r in read_lines(spark, out).collect())
    assert lines == ['1|"a|b"', "2|", '3|""', '4|"q\\"x"']


def test_s13_one_column_null_row_and_the_marker_that_keeps_it(spark, work):
    df = urls(spark, ["a", None, "b"])
    out = os.path.join(work, "one")
    export_delimited(df, out, max_files=1)
    # Spark's CSV writer skips a row whose cells are all null: the documented loss.
    assert sorted(r.value for r in read_lines(spark, out).collect()) == ["a", "b"]
    kept = os.path.join(work, "kept")
    export_delimited(df, kept, max_files=1, null_value="\\N")
    assert sorted(r.value for r in read_lines(spark, kept).collect()) == ["\\N", "a", "b"]
    back = spark.read.schema("url string").option("nullValue", "\\N").csv(kept)
    assert rows(back) == sorted([("a",), (None,), ("b",)], key=repr)
    # With a second, non-null column nothing is lost.
    two = os.path.join(work, "two")
    export_delimited(spark.createDataFrame([(1, None), (2, "x")], "k int, v string"), two)
    assert spark.read.schema("k int, v string").option("sep", "|").csv(two).count() == 2


def test_export_part_file_bound(spark, work):
    df = spark.range(0, 1000).repartition(20)
    out = os.path.join(work, "parts")
    export_delimited(df, out, max_files=3)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert 1 <= len(parts) <= 3


def test_read_lines_missing_folder_is_empty(spark, work):
    assert read_lines(spark, os.path.join(work, "missing")).count() == 0


def test_list_files_and_missing_folder(spark, work):
    for name in ("x.gz", "y.gz", "_hidden"):
        with open(os.path.join(work, name), "w") as fh:
            fh.write("1")
    got = sorted(os.path.basename(r.path) for r in list_files(spark, work).collect())
    assert got == ["x.gz", "y.gz"]
    with pytest.raises(AnalysisException):
        list_files(spark, os.path.join(work, "missing")).collect()


def test_csv_list_with_header(spark, work):
    path = os.path.join(work, "list.csv")
    with open(path, "w") as fh:
        fh.write("warc_filename\ncrawl-data/a/warc/x.warc.gz\ncrawl-data/b/warc/y.warc.gz\n")
    assert rows(read_csv_list(spark, path)) == [("crawl-data/a/warc/x.warc.gz",),
                                                 ("crawl-data/b/warc/y.warc.gz",)]


def test_catalog_table_and_database(spark):
    create_database(spark, "linkloom_test_db")
    assert "linkloom_test_db" in [d.name for d in spark.catalog.listDatabases()]
    urls(spark, ["a", "b"]).createOrReplaceTempView("linkloom_audit_view")
    assert read_catalog_table(spark, "linkloom_audit_view").count() == 2


def jobs_of(spark, fn):
    """Ids of the Spark jobs that ``fn`` starts."""
    group = f"watch-{id(fn)}"
    spark.sparkContext.setJobGroup(group, "test")
    fn()
    return spark.sparkContext.statusTracker().getJobIdsForGroup(group)


def test_bound_files_keeps_upstream_parallel_and_starts_no_job(spark):
    from linkloom.sinks.tables import bound_files
    for partitions in (3, 12, 40):
        wide = spark.range(0, 1000, numPartitions=partitions).distinct()
        assert len(jobs_of(spark, lambda: bound_files(wide, 5))) == 0
        assert bound_files(wide, 5).count() == 1000
    assert bound_files(spark.range(100), 5).rdd.getNumPartitions() == 5


def test_flagship_plan_has_no_round_robin_shuffle(spark):
    from linkloom.plans import registry
    for name in ("page_links", "distinct_links"):
        plan = registry.get(name).run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "RoundRobin" not in plan


def test_listing_tasks_are_bounded(spark, work):
    for i in range(30):
        with open(os.path.join(work, f"f {i}.gz"), "w") as fh:
            fh.write("1")
    listed = list_files(spark, work)
    assert listed.rdd.getNumPartitions() <= 8
    assert {r.path.rsplit("/", 1)[1] for r in listed.collect()} == {f"f {i}.gz" for i in range(30)}


def test_new_urls_only_shuffles_each_side_once(spark):
    from linkloom.operators.dedup import new_urls_only
    a, b = (spark.range(10).selectExpr("cast(id as string) url") for _ in range(2))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new_urls_only(a, b)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2


def test_csv_list_goes_by_header_names(spark, work):
    path = os.path.join(work, "l.csv")
    with open(path, "w") as fh:
        fh.write("id,warc_filename,size\n7,crawl-data/a/warc/x.warc.gz,10\n")
    got = read_csv_list(spark, path)
    assert got.columns == ["id", "warc_filename", "size"]
    assert rows(got) == [("7", "crawl-data/a/warc/x.warc.gz", "10")]
    with pytest.raises(ValueError, match="warc_filename"):
        with open(path, "w") as fh:
            fh.write("id,name\n7,x\n")
        read_csv_list(spark, path)


def test_list_files_is_one_level_files_only(spark, work):
    os.makedirs(os.path.join(work, "sub"))
    for name in ("top.gz", os.path.join("sub", "inner.gz")):
        with open(os.path.join(work, name), "w") as fh:
            fh.write("1")
    got = sorted(r.path.split("/")[-1] for r in list_files(spark, work).collect())
    assert got == ["top.gz"]  # one level; a sub-folder is not listed


def test_catalog_tables_by_name(spark):
    from linkloom.operators.ledger import mark_processed, read_ledger
    from linkloom.tables import LinkTable, as_table
    create_database(spark, "linkloom_cat")
    t = as_table("catalog:linkloom_cat.raw_links")
    assert t.in_catalog and str(t) == "linkloom_cat.raw_links"
    assert not table_exists(spark, t)
    assert create_or_append(urls(spark, ["a"]), t) is False
    append_table(urls(spark, ["b"]), t)
    assert table_exists(spark, t)
    assert rows(read_table(spark, t)) == [("a",), ("b",)]
    assert rows(read_catalog_table(spark, "linkloom_cat.raw_links")) == [("a",), ("b",)]
    overwrite_table(urls(spark, ["z"]), t)
    assert rows(read_table(spark, t)) == [("z",)]
    with pytest.raises(AnalysisException):
        create_new_table(urls(spark, ["y"]), t)
    ledger = LinkTable.catalog("linkloom_cat.ledger")
    assert read_ledger(spark, ledger).count() == 0
    mark_processed(spark.createDataFrame([("f.gz",)], "file_name string"), ledger)
    assert rows(read_ledger(spark, ledger)) == [("f.gz",)]
    with pytest.raises(ValueError):
        LinkTable()


def test_session_defaults_do_not_override_launcher_settings(spark):
    from linkloom.session import DEFAULT_SQL_CONF, build_session
    again = build_session("again")
    assert again is spark or again.sparkContext is spark.sparkContext
    for key in DEFAULT_SQL_CONF:
        assert again.conf.get(key) is not None
    launched = spark.sparkContext.getConf()
    assert launched.get("spark.sql.shuffle.partitions") == "8"  # caller's value kept


def test_shuffle_sizing_respects_explicit_settings(spark):
    from linkloom.session import SHUFFLE_KEYS, size_shuffles
    key = SHUFFLE_KEYS[1]
    before = spark.conf.get(key, None)
    size_shuffles(spark)  # the test session set shuffle partitions: nothing changes
    assert spark.conf.get(key, None) == before


def test_export_trims_spaces_unless_asked(spark, work):
    df = spark.createDataFrame([(1, " a "), (2, "b\nc")], "k int, v string")
    trimmed, kept = os.path.join(work, "trim"), os.path.join(work, "keep")
    export_delimited(df, trimmed, max_files=1)
    export_delimited(df, kept, max_files=1, trim_spaces=False)
    read = lambda p: rows(spark.read.schema("k int, v string").option("sep", "|")
                          .option("multiLine", True).csv(p))
    assert read(trimmed) == [(1, "a"), (2, "b\nc")]
    assert read(kept) == [(1, " a "), (2, "b\nc")]


def test_launcher_settings_win_in_a_fresh_process():
    import subprocess
    import sys
    code = ("from linkloom.session import build_session; s = build_session('t', master='local[1]');"
            "print('WAIT', s.sparkContext.getConf().get('spark.locality.wait'),"
            " s.sparkContext.getConf().get('spark.ui.enabled'))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root,
           "PYSPARK_SUBMIT_ARGS": "--conf spark.locality.wait=7s pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "WAIT 7s false" in out.stdout, out.stderr[-2000:]


def test_scratch_folder_must_be_shared_on_a_cluster(spark):
    from linkloom.session import checkpoint_root

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_partitions_of_a_table_made_elsewhere_are_overwritten_one_by_one(spark):
    """A table that carries no write option of this library keeps the
    partitions the rows do not name, and the session keeps its settings."""
    from linkloom.sinks.tables import create_database, overwrite_partitions
    create_database(spark, "linkloom_parts")
    name = unique_name("linkloom_parts.t")
    spark.sql(f"CREATE TABLE {name} (url STRING, run STRING) USING parquet PARTITIONED BY (run)")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    for run, urls in (("a", ["u1", "u2"]), ("b", ["u3"]), ("a", ["u4"])):
        df = spark.createDataFrame([(u, run) for u in urls], "url string, run string")
        overwrite_partitions(df, LinkTable.catalog(name), ["run"], max_records_per_file=1)
    assert rows(spark.table(name)) == [("u3", "b"), ("u4", "a")]
    assert spark.conf.get(key) == before


def test_create_or_append_keeps_the_tables_columns(spark, work):
    from linkloom.sinks.tables import create_database, create_or_append
    create_database(spark, "linkloom_parts")
    for table in (LinkTable(os.path.join(work, "t")), LinkTable.catalog(unique_name("linkloom_parts.c"))):
        first = spark.createDataFrame([("u1", "x")], "url string, text string")
        assert create_or_append(first, table) is False
        assert create_or_append(first.select("text", "url"), table) is True
        assert rows(read_table(spark, table), "url", "text") == [("u1", "x")] * 2
        with pytest.raises(ValueError, match="columns"):
            create_or_append(first.select("url"), table)
