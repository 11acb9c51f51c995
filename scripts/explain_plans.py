"""Write the physical plan of every registered query (and the streaming plan
of every stream job) to PLANS.md.

Usage: python scripts/explain_plans.py [sf_dir] [out.md]
For queries that write first, the plan of every distinct write is shown before
the plan of the DataFrame they return; stream jobs are shown as streaming plans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"file:[^,\]\s]*/linkloom-([a-z]+)-[0-9a-f]+[^,\]\s]*", r"<work:\1>", text)
    text = re.sub(r"#\d+L?", "", text)
    return text.rstrip()


class Writes:
    """Records the plan of every batch write while it is open."""

    METHODS = ("save", "parquet", "csv", "text", "json", "saveAsTable", "insertInto")

    def __enter__(self):
        from pyspark.sql.classic.dataframe import DataFrame  # noqa: F401  (the session is classic)
        from pyspark.sql import DataFrameWriter

        self.seen, self.cls = [], DataFrameWriter
        self.kept = {m: getattr(DataFrameWriter, m) for m in self.METHODS}
        for name, method in self.kept.items():
            def recorded(writer, *args, _method=method, **kw):
                text = plan_text(writer._df)
                if text not in self.seen:
                    self.seen.append(text)
                return _method(writer, *args, **kw)
            setattr(DataFrameWriter, name, recorded)
        return self

    def __exit__(self, *exc):
        for name, method in self.kept.items():
            setattr(self.cls, name, method)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(__file__), "..", "PLANS.md")
    from linkloom.plans import registry
    from linkloom.session import build_session, join_path, new_work_dir
    from linkloom.sources.derived import raw_links_table, wat_files_folder
    from linkloom.streaming.jobs import STREAMS, StreamLayout, read_table_stream

    spark = build_session("plans", master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    raw_links_table(spark, sf_dir)
    raw_links_table(spark, sf_dir, by_suffix=True)
    wat_files_folder(spark, sf_dir)
    parts = ["# Physical plans\n",
             f"Generated by `scripts/explain_plans.py` on `{sf_dir}` (AQE shows the initial plan;"
             " work folders are abbreviated). Inputs that many queries share are written once"
             " before.\n"]
    for name, q in registry.REGISTRY.items():
        if name.startswith("stream_"):
            continue
        with Writes() as writes:
            df = q.run(spark, sf_dir)
        parts.append(f"## {name}\n")
        parts += [f"Write {i}:\n\n```\n{text}\n```\n" for i, text in enumerate(writes.seen, 1)]
        parts.append(f"```\n{plan_text(df)}\n```\n")
    work = new_work_dir(spark, "plans")
    layout = StreamLayout(base=join_path(work, "t"), checkpoints=join_path(work, "c"),
                          raw_path=raw_links_table(spark, sf_dir))
    for spec in STREAMS:
        if spec.source != "raw":
            continue
        df = spec.transform(read_table_stream(spark, layout, spec.source, spec.max_files))
        text = df._jdf.queryExecution().logical().toString()
        text = re.sub(r"#\d+L?", "", text)
        parts.append(f"## stream {spec.name} ({spec.title}): streaming logical plan\n\n```\n{text.rstrip()}\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
