"""Plain sources: CSV file lists, tables by path or name, folder listings and
line files. All are lazy DataFrames; nothing is read into the driver."""

from __future__ import annotations

import re
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import LINES_SCHEMA, WARC_LIST_SCHEMA
from ..tables import LinkTable, as_table


LISTING_TASKS = 8
COPY_BYTES = 1 << 20


def is_path_not_found(exc: AnalysisException) -> bool:
    condition = None
    for getter in ("getCondition", "getErrorClass"):
        fn = getattr(exc, getter, None)
        if fn is not None:
            try:
                condition = fn()
            except Exception:  # pragma: no cover - older error classes
                condition = None
            if condition:
                break
    if condition:
        return condition == "PATH_NOT_FOUND"
    return "Path does not exist" in str(exc)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_csv_list(spark: SparkSession, path: str, column: str = WARC_LIST_SCHEMA[0].name,
                  sep: str = ",") -> DataFrame:
    """CSV file list: columns by the names in its header, all strings (no
    inference pass). A list without ``column`` is an error."""
    listed = spark.read.option("header", True).option("sep", sep).csv(path)
    if column not in listed.columns:
        raise ValueError(f"{path} has no column {column!r}, only {listed.columns}")
    return listed


def read_table(spark: SparkSession, table: LinkTable | str) -> DataFrame:
    """A table by path (parquet by default, any format by name) or by its
    catalog name."""
    table = as_table(table)
    if table.in_catalog:
        return spark.table(table.name)
    return spark.read.format(table.fmt).load(table.path)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table (or view) registered in the session catalog."""
    return spark.table(name)


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Files of a folder as rows ``path`` (one level: files inside
    sub-folders are not listed, nor is the sub-folder itself); a missing
    folder is an error.

    Spark's file index lists the folder, and the names stay with it: they are
    read by a bounded number of tasks, which open no file. Each use of the
    result lists the folder again; store it to list once.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path").coalesce(LISTING_TASKS)


def literal_path(path: str) -> str:
    """A path for Spark's readers in which ``[``, ``*`` and their like mean themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every file in a folder as ``value``; a missing folder gives
    no rows. Lines are not parsed (no CSV unquoting); blank lines are kept."""
    try:
        return spark.read.text(folder)
    except AnalysisException as exc:
        if is_path_not_found(exc):
            return empty_frame(spark, LINES_SCHEMA)
        raise


def read_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    return spark.range(start, end)


def table_exists(spark: SparkSession, table: LinkTable | str) -> bool:
    """False only when the path does not exist; any other error is raised.
    A catalog table exists when the catalog knows its name."""
    table = as_table(table)
    if table.in_catalog:
        return spark.catalog.tableExists(table.name)
    try:
        spark.read.format(table.fmt).load(table.path)
        return True
    except AnalysisException as exc:
        if is_path_not_found(exc):
            return False
        raise


# --- folders and small notes, through the path's own file system -----------------


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme it has on this cluster."""
    jpath, fs = _hadoop(spark, path)
    return fs.makeQualified(jpath).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return fs.exists(jpath)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of one folder, hidden ones too."""
    jpath, fs = _hadoop(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def write_note(spark: SparkSession, path: str, text: str) -> None:
    jpath, fs = _hadoop(spark, path)
    out = fs.create(jpath, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    jpath, fs = _hadoop(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; what lies at the target is replaced."""
    jsource, fs = _hadoop(spark, source)
    jtarget, _ = _hadoop(spark, target)
    if fs.exists(jtarget):
        fs.delete(jtarget, True)
    if not fs.rename(jsource, jtarget):
        raise OSError(f"could not move {source} to {target}")


def copy_file(spark: SparkSession, source: str, target: str, keep: float = 1.0) -> None:
    """Copy a file, or its first part."""
    jsource, fs = _hadoop(spark, source)
    jtarget, target_fs = _hadoop(spark, target)
    size = int(fs.getFileStatus(jsource).getLen() * keep)
    read, written = fs.open(jsource), target_fs.create(jtarget, True)
    try:
        for at in range(0, size, COPY_BYTES):
            written.write(bytearray(read.readNBytes(min(COPY_BYTES, size - at))))
    finally:
        written.close()
        read.close()


def set_modified(spark: SparkSession, path: str, offset_ms: int) -> None:
    """Set a file's modification time to now plus an offset."""
    jpath, fs = _hadoop(spark, path)
    fs.setTimes(jpath, int(time.time() * 1000) + offset_ms, -1)
