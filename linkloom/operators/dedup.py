"""One row per url.

Every form here is a hash-partitioned aggregate with a map-side partial
step: a url that holds a third of all rows is folded to one row per map
task before the shuffle, so no reducer receives more than one row per
map partition for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """One row per url; which row survives is not defined (null is one group)."""
    return df.dropDuplicates([url])


def dedup_stable(df: DataFrame, order_by: Sequence[str], url: str = "url") -> DataFrame:
    """One row per url: the row that is smallest by ``order_by``.

    ``min`` over a struct whose leading fields are the ordering columns picks
    a whole row deterministically; columns keep their input order.
    """
    order_by = list(order_by)
    rest = [c for c in df.columns if c != url and c not in order_by]
    packed = F.struct(*[F.col(f"`{c}`") for c in order_by + rest])
    best = df.groupBy(url).agg(F.min(packed).alias("_best"))
    return best.select(*[F.col(url) if c == url else F.col(f"_best.`{c}`").alias(c)
                         for c in df.columns])


def distinct_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """Distinct url values only (a keys-only hash aggregate)."""
    return df.select(url).distinct()


def new_urls_only(df: DataFrame, existing: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose url is not yet in ``existing`` (null matches null), so that
    appending the result to ``existing`` keeps it free of repeats. An anti
    join does not mind repeats on its right side, so each side is shuffled once."""
    known = existing.select(F.col(url).alias("_known_url"))
    return df.join(known, df[url].eqNullSafe(known["_known_url"]), "left_anti")
