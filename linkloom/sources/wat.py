"""Crawl metadata (WAT) reader: gzipped JSON lines -> one row per hyperlink.

Gzip files are not splittable, so each file is one task; a multi-path read
of all pending files runs them in parallel. The fixed schema means there is
no inference job and the JSON parser only materialises the link array.
Lines that are not JSON (the WARC header lines between records), records
without HTML metadata and empty link arrays give no rows and no error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ENVELOPE, HTML_META, HTTP_RESPONSE, LINK_FIELDS, LINK_SCHEMA, LINKS, PAYLOAD, WAT_SCHEMA
from .files import literal_path


def links_array() -> Column:
    """The nested link array; the hyphenated names need the quoted path."""
    return F.col(f"`{ENVELOPE}`.`{PAYLOAD}`.`{HTTP_RESPONSE}`.`{HTML_META}`.`{LINKS}`")


def explode_links(records: DataFrame, *keep: str) -> DataFrame:
    """Records with an ``Envelope`` column -> five link columns (plus ``keep``)."""
    exploded = records.select(*keep, F.explode(links_array()).alias("link"))
    return exploded.select(*keep, *[F.col(f"link.{name}").alias(name) for name in LINK_FIELDS])


def read_wat_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    if isinstance(paths, str):
        paths = [paths]
    return (spark.read.schema(WAT_SCHEMA)
            .option("mode", "PERMISSIVE")
            .json(list(paths)))


def read_wat_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The links of the files with these names, taken literally; none for no names."""
    if not paths:
        return spark.createDataFrame([], LINK_SCHEMA)
    return read_wat_links(spark, [literal_path(p) for p in paths])


def read_wat_links(spark: SparkSession, paths: str | Sequence[str],
                   with_source: bool = False) -> DataFrame:
    """WAT file(s) or folder(s) -> ``path, target, text, title, url``.

    With ``with_source`` the base name of the file each link came from is
    added as ``file_name`` (from the scan's ``_metadata``; no extra read).
    """
    records = read_wat_records(spark, paths)
    if with_source:
        records = records.select(ENVELOPE, F.col("_metadata.file_name").alias("file_name"))
        return explode_links(records, "file_name")
    return explode_links(records)
