"""Command-line jobs: one sub-command per job of the original application.

    python -m linkloom warc-to-wat   --csv LIST.csv --out WAT_LIST [--warc-table T --wat-table T]
                                     [--create-database DB]
    python -m linkloom plan-downloads N --url-list DIR --ledger TABLE [--out DIR]
    python -m linkloom download N    --url-list DIR --ledger TABLE --dest DIR --report TABLE
    python -m linkloom mark-done     --names DIR --ledger TABLE
    python -m linkloom ingest        --wat DIR --ledger TABLE --raw TABLE
    python -m linkloom ingest-stream --wat DIR --raw DIR --checkpoint DIR [--archive DIR]
    python -m linkloom extract       jpg-jpeg|png --raw TABLE --out TABLE
    python -m linkloom dedup         --src TABLE --dst TABLE [--order-by c1,c2] [--skip-existing]
    python -m linkloom export        --table TABLE --out DIR
    python -m linkloom stream        st1..st12|fan-in --base DIR [--raw DIR] [--once]
    python -m linkloom audit         --table NAME_OR_PATH
    python -m linkloom range-smoke   --out DIR

Paths are parameters (no host paths are built in); a table argument may also
be ``catalog:db.table`` for a table of the session catalog. ``--format`` chooses the
table format (parquet by default, delta when its package is present). The
session comes from the launcher (``spark-submit`` settings win), with the
library defaults for what is unset.
"""

from __future__ import annotations

import argparse
import sys

from .functions.names import is_count_arg
from .session import build_session, join_path
from .tables import CATALOG_PREFIX, LinkTable, as_table


def _table(spec: str, fmt: str) -> LinkTable:
    """A folder path, or ``catalog:db.table`` for a metastore table."""
    return as_table(spec, fmt)


def cmd_warc_to_wat(spark, a) -> None:
    from .plans.warc_list import convert_warc_list, export_table, load_warc_list, warc_csv_to_wat_list
    from .sinks.tables import create_database
    if a.create_database:
        create_database(spark, a.create_database)
    if a.warc_table and a.wat_table:
        load_warc_list(spark, a.csv, _table(a.warc_table, a.format))
        convert_warc_list(spark, _table(a.warc_table, a.format), _table(a.wat_table, a.format))
        export_table(spark, _table(a.wat_table, a.format), a.out)
    else:
        warc_csv_to_wat_list(spark, a.csv, a.out)


def cmd_plan_downloads(spark, a) -> None:
    from .operators.ledger import download_plan, read_ledger
    from .sinks.tables import export_delimited
    from .sources.files import read_lines
    if not is_count_arg(a.n):
        raise SystemExit("usage: plan-downloads <numberOfFiles> ...")
    plan = download_plan(read_lines(spark, a.url_list), read_ledger(spark, _table(a.ledger, a.format)),
                         int(a.n))
    if a.out:
        export_delimited(plan.select("url"), a.out, max_files=1)
    else:  # the plan is bounded by n rows
        for row in plan.collect():
            print(row.url)


def cmd_download(spark, a) -> None:
    from .plans.fetch import fetch_and_mark
    if not is_count_arg(a.n):
        raise SystemExit("usage: download <numberOfFiles> ...")
    report = fetch_and_mark(spark, a.url_list, _table(a.ledger, a.format), int(a.n), a.dest,
                            _table(a.report, a.format), retries=a.retries, wait_s=a.wait)
    done = report.where("ok").count()
    print(f"Number of files downloaded {done}")


def cmd_mark_done(spark, a) -> None:
    from pyspark.sql import functions as F

    from .functions.names import file_name_of_url
    from .operators.ledger import mark_processed
    from .sources.files import read_lines
    names = read_lines(spark, a.names).select(file_name_of_url(F.col("value")).alias("file_name"))
    mark_processed(names.where(F.col("file_name") != ""), _table(a.ledger, a.format))


def cmd_ingest(spark, a) -> None:
    from .plans.ingest import ingest_wat_files
    result = ingest_wat_files(spark, a.wat, _table(a.ledger, a.format), _table(a.raw, a.format),
                              glob=a.glob, partition_by_suffix=a.partition_by_suffix,
                              retry_quarantined=a.retry_quarantined)
    print(f"ingested {result.count} file(s)")


def cmd_ingest_stream(spark, a) -> None:
    from .streaming.ingest import start_ingest_stream
    q = start_ingest_stream(spark, a.wat, a.raw, a.checkpoint, max_files=a.max_files, job=a.job,
                            archive_dir=a.archive, fmt=a.format, available_now=a.once,
                            partition_by_suffix=a.partition_by_suffix)
    q.awaitTermination()


def cmd_extract(spark, a) -> None:
    from .plans.extract import extract_jp_jpg_jpeg, extract_jp_png
    job = {"jpg-jpeg": extract_jp_jpg_jpeg, "png": extract_jp_png}[a.kind]
    job(spark, _table(a.raw, a.format), _table(a.out, a.format))


def cmd_dedup(spark, a) -> None:
    from .plans.extract import deduplicate_table
    order = [c for c in (a.order_by or "").split(",") if c]
    deduplicate_table(spark, _table(a.src, a.format), _table(a.dst, a.format),
                      order_by=order or None, skip_existing=a.skip_existing)


def cmd_export(spark, a) -> None:
    from .plans.warc_list import export_table
    export_table(spark, _table(a.table, a.format), a.out, max_files=a.max_files,
                 null_value=a.null_value, trim_spaces=not a.keep_spaces)


def cmd_stream(spark, a) -> None:
    from .streaming.jobs import SPECS, StreamLayout, start_feed, start_stream
    if a.base.startswith(CATALOG_PREFIX) and not a.checkpoints:
        raise SystemExit("give --checkpoints: a folder, for tables of a catalog")
    layout = StreamLayout(base=a.base, checkpoints=a.checkpoints or join_path(a.base, "_checkpoints"),
                          fmt=a.format, raw_path=a.raw, ledger=a.ledger and _table(a.ledger, a.format))
    if a.job == "fan-in":
        q = start_feed(spark, layout, "kr_http_links", max_files=a.max_files, available_now=a.once)
    else:
        q = start_stream(spark, SPECS[a.job], layout, available_now=a.once, max_files=a.max_files)
    q.awaitTermination()


def cmd_audit(spark, a) -> None:
    from .operators.audit import schema_text
    from .plans.extract import audit_path, audit_table
    from .sources.files import read_table
    spec = a.table
    if "/" not in spec and ":" not in spec:  # a bare name is a catalog table
        spec = CATALOG_PREFIX + spec
    table = _table(spec, a.format)
    df = audit_table(spark, table.name) if table.in_catalog else audit_path(spark, table)
    print(f"##### Count {df.first().row_count}")
    print(schema_text(read_table(spark, table)))


def cmd_range_smoke(spark, a) -> None:
    from .sinks.tables import create_new_table
    from .sources.files import read_range
    create_new_table(read_range(spark, 0, 5), _table(a.out, a.format))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linkloom", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--format", default="parquet", help="table format (parquet, delta, ...)")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit decides otherwise")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("warc-to-wat")
    s.add_argument("--csv", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--warc-table")
    s.add_argument("--wat-table")
    s.add_argument("--create-database", help="create this catalog database first")
    s.set_defaults(fn=cmd_warc_to_wat)

    s = sub.add_parser("plan-downloads")
    s.add_argument("n")
    s.add_argument("--url-list", required=True)
    s.add_argument("--ledger", required=True)
    s.add_argument("--out")
    s.set_defaults(fn=cmd_plan_downloads)

    s = sub.add_parser("download")
    s.add_argument("n")
    s.add_argument("--url-list", required=True)
    s.add_argument("--ledger", required=True)
    s.add_argument("--dest", required=True, help="folder for the files, on a file system that all executors share")
    s.add_argument("--report", required=True, help="table recording every attempt")
    s.add_argument("--retries", type=int, default=10)
    s.add_argument("--wait", type=float, default=5.0, help="seconds between tries")
    s.set_defaults(fn=cmd_download)

    s = sub.add_parser("mark-done")
    s.add_argument("--names", required=True, help="folder of url lines whose files are done")
    s.add_argument("--ledger", required=True)
    s.set_defaults(fn=cmd_mark_done)

    s = sub.add_parser("ingest")
    s.add_argument("--wat", required=True)
    s.add_argument("--ledger", required=True)
    s.add_argument("--raw", required=True)
    s.add_argument("--glob")
    s.add_argument("--partition-by-suffix", action="store_true",
                   help="partition the raw table by url image suffix (prunes image selections)")
    s.add_argument("--retry-quarantined", action="store_true", help="take files again that could not be read")
    s.set_defaults(fn=cmd_ingest)

    s = sub.add_parser("ingest-stream")
    s.add_argument("--wat", required=True)
    s.add_argument("--raw", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--archive")
    s.add_argument("--max-files", default="auto",
                   help="files per micro-batch: a number, or 'auto' (a thousand; default)")
    s.add_argument("--job", default="ingest", help="name of this job among those filling the raw table")
    s.add_argument("--once", action="store_true", help="take what is there and stop")
    s.add_argument("--partition-by-suffix", action="store_true")
    s.set_defaults(fn=cmd_ingest_stream)

    s = sub.add_parser("extract")
    s.add_argument("kind", choices=["jpg-jpeg", "png"])
    s.add_argument("--raw", required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_extract)

    s = sub.add_parser("dedup")
    s.add_argument("--src", required=True)
    s.add_argument("--dst", required=True)
    s.add_argument("--order-by")
    s.add_argument("--skip-existing", action="store_true")
    s.set_defaults(fn=cmd_dedup)

    s = sub.add_parser("export")
    s.add_argument("--table", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--max-files", type=int, default=100)
    s.add_argument("--null-value", help="marker for null cells (also keeps rows that are all null)")
    s.add_argument("--keep-spaces", action="store_true", help="keep leading and trailing spaces")
    s.set_defaults(fn=cmd_export)

    s = sub.add_parser("stream")
    s.add_argument("job", choices=[f"st{i}" for i in range(1, 13)] + ["fan-in"])
    s.add_argument("--base", required=True, help="folder holding the tables, or catalog:DATABASE")
    s.add_argument("--raw", help="raw link table (default BASE/raw)")
    s.add_argument("--ledger", help="read only the ingest runs that are complete by this ledger")
    s.add_argument("--checkpoints")
    s.add_argument("--max-files", default="auto",
                   help="files per micro-batch: a number, or 'auto' (a thousand; default)")
    s.add_argument("--once", action="store_true", help="take what is there and stop")
    s.set_defaults(fn=cmd_stream)

    s = sub.add_parser("audit")
    s.add_argument("--table", required=True)
    s.set_defaults(fn=cmd_audit)

    s = sub.add_parser("range-smoke")
    s.add_argument("--out", required=True)
    s.set_defaults(fn=cmd_range_smoke)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"linkloom-{args.cmd}", master=args.master)
    args.fn(spark, args)
    return 0


if __name__ == "__main__":  # pragma: no cover
    sys.exit(main())
