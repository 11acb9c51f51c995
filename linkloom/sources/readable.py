"""Which compressed files can be read to their end.

A narrow job: each task reads its files through ``pyarrow.fs`` in pieces and
checks every gzip member against the length and checksum in its trailer. It
runs only where a read has failed, so files that are whole cost nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECK_SCHEMA = "path string, error string"
FILES_PER_TASK = 8


def _checker():
    """The per-partition function, shipped by value: executors need no copy of
    this library."""

    def run(batches):
        import zlib

        import pandas as pd
        from pyarrow import fs as pafs

        piece = 1 << 20

        def opened(path):
            scheme, _, rest = path.partition(":")
            if not rest or "/" in scheme:  # no scheme
                return pafs.LocalFileSystem().open_input_file(path)
            if scheme == "file":
                return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
            host, _, inside = rest.lstrip("/").partition("/")
            scheme = "s3" if scheme in ("s3a", "s3n") else scheme
            filesystem, root = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
            return filesystem.open_input_file(f"{root.rstrip('/')}/{inside}")

        def fault(path):
            try:
                source = opened(path)
            except FileNotFoundError as exc:
                return f"FileNotFoundError: {exc}"
            with source:
                gz = path.endswith(".gz")
                state, inside = zlib.decompressobj(wbits=31), False
                while True:
                    data = source.read(piece)
                    if not data:
                        return "unexpected end of the gzip file" if gz and inside else None
                    while gz and data:
                        if not inside:  # the next member; Spark's reader takes nothing else there
                            state, inside = zlib.decompressobj(wbits=31), True
                        try:
                            state.decompress(data, piece)
                            while state.unconsumed_tail:
                                state.decompress(state.unconsumed_tail, piece)
                        except zlib.error as exc:
                            return f"zlib.error: {exc}"
                        data, inside = state.unused_data, not state.eof

        for pdf in batches:
            found = [(p, fault(p)) for p in pdf["path"]]
            yield pd.DataFrame(found, columns=["path", "error"]).dropna()

    return run


def unreadable_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, error`` of the files among ``paths`` that cannot be read whole:
    gone, cut off or damaged. Only gzip files are looked into."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.repartition(max(1, -(-len(paths) // FILES_PER_TASK))).mapInPandas(_checker(), CHECK_SCHEMA)
