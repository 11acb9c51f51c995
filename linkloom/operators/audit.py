"""Table audit: row count and schema of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row ``table_name, row_count``; the count is a distributed aggregate
    (per-partition partial counts, one tiny final merge)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count")


def schema_text(df: DataFrame) -> str:
    return df.schema.treeString()
