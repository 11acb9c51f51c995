"""Batch extract jobs over the raw link table.

Each reads the table once, filters (narrow), and appends. Appending twice
doubles the rows, as the source jobs do; ``skip_existing`` instead appends
only urls the target does not hold yet (an anti join on url).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit import row_count
from ..operators.dedup import dedup_stable, dedup_urls, new_urls_only
from ..operators.filters import jp_jpg_jpeg, jp_png, link_columns
from ..sinks.tables import append_table, create_or_append
from ..sources.files import read_catalog_table, read_table, table_exists
from ..tables import LinkTable, as_table


def extract_jp_jpg_jpeg(spark: SparkSession, raw: LinkTable | str, out: LinkTable | str) -> None:
    """Japanese jpg + jpeg links of the raw table with their link columns: the
    table is created, or appended to."""
    create_or_append(link_columns(jp_jpg_jpeg(read_table(spark, raw))), out)


def extract_jp_png(spark: SparkSession, raw: LinkTable | str, out: LinkTable | str) -> None:
    create_or_append(link_columns(jp_png(read_table(spark, raw))), out)


def deduplicate_table(spark: SparkSession, src: LinkTable | str, dst: LinkTable | str,
                      order_by: Sequence[str] | None = None,
                      skip_existing: bool = False) -> None:
    """One row per url of ``src`` appended to ``dst``.

    ``order_by`` picks the surviving row deterministically (smallest);
    without it any row of the group may survive.
    """
    dst = as_table(dst)
    links = read_table(spark, src)
    unique = dedup_stable(links, order_by) if order_by else dedup_urls(links)
    if skip_existing and table_exists(spark, dst):
        unique = new_urls_only(unique, read_table(spark, dst))
    append_table(unique, dst)


def audit_table(spark: SparkSession, name: str) -> DataFrame:
    """Row count of a catalog table, as a one-row DataFrame."""
    return row_count(read_catalog_table(spark, name), name)


def audit_path(spark: SparkSession, table: LinkTable | str, name: str | None = None) -> DataFrame:
    table = as_table(table)
    return row_count(read_table(spark, table), name or str(table))
