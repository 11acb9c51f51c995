"""Several append-only selections into one table, as one pass.

Each row is tagged with the name of every rule it matches and exploded:
a link matching two rules is stored twice, exactly as two streams
appending to one table would store it. The rules are data, so adding a
site is adding a ``Rule``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import KR_FAN_IN, Rule, matching_rule_names


def tag_rules(df: DataFrame, rules: Sequence[Rule] = KR_FAN_IN,
              keep: Sequence[str] = ("url",), url: str = "url") -> DataFrame:
    """``rule, *keep``: one row per (row, matching rule). Narrow: no shuffle."""
    return df.select(F.explode(matching_rule_names(list(rules), url)).alias("rule"), *keep)
