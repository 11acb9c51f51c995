"""Anti join on a key.

The join is left to the planner: sort-merge or hash on the key, with AQE free
to broadcast a side whose measured bytes are small and to split skewed
partitions. No counting job and no hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def anti_join(left: DataFrame, right: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows of ``left`` with no match in ``right``."""
    return left.join(right, on, "left_anti")
