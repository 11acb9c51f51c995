"""WARC file list (CSV) -> WAT download urls -> exported text list.

One lazy plan from the CSV scan to the sink: scan, two regex rewrites and
a prefix, written as a table; the export deals the rows out over a bounded
number of delimited text files (see ``sinks.tables.bound_files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import WAT_URL_PREFIX, warc_to_wat
from ..sinks.tables import export_delimited, overwrite_table
from ..sources.files import read_csv_list, read_table
from ..tables import LinkTable, as_table


def load_warc_list(spark: SparkSession, csv_path: str, table: LinkTable | str) -> None:
    """CSV with header -> table (overwrite)."""
    overwrite_table(read_csv_list(spark, csv_path), as_table(table))


def convert_warc_list(spark: SparkSession, warc_table: LinkTable | str,
                      wat_table: LinkTable | str, prefix: str = WAT_URL_PREFIX) -> DataFrame:
    """Overwrite ``wat_table`` with the WAT urls of ``warc_table``; return it."""
    wat_table = as_table(wat_table)
    overwrite_table(warc_to_wat(read_table(spark, warc_table), prefix=prefix), wat_table)
    return read_table(spark, wat_table)


def export_table(spark: SparkSession, table: LinkTable | str, path: str, **kw) -> None:
    export_delimited(read_table(spark, table), path, **kw)


def warc_csv_to_wat_list(spark: SparkSession, csv_path: str, export_path: str,
                         prefix: str = WAT_URL_PREFIX, **kw) -> None:
    """The whole job without intermediate tables: CSV -> WAT urls -> text, one
    url a line whatever else the list holds."""
    urls = warc_to_wat(read_csv_list(spark, csv_path), prefix=prefix).select("full_wat_path")
    export_delimited(urls, export_path, **kw)
