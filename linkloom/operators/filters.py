"""Link selection: ``DataFrame -> DataFrame`` transforms for ``df.transform``.

All of them are narrow (no shuffle). Several rules on one input become one
predicate, so the input is scanned once however many rules apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schema import BOOKKEEPING_COLUMNS

from ..functions.rules import (JP, JPEG, JPG, PNG, SUFFIX_COLUMN, Rule, all_of, any_of, rule,
                               suffix_pruning, url_present, url_suffix_class)


def _prune(df: DataFrame, cond, rules, any_of_rules: bool = False):
    """Add the implied suffix-class predicate on a suffix-partitioned table."""
    extra = suffix_pruning(df.columns, rules, any_of_rules)
    return cond if extra is None else extra & cond


def select_links(df: DataFrame, *rules: Rule | str, url: str = "url") -> DataFrame:
    """Rows whose url is present and matches every rule."""
    resolved = [r if isinstance(r, Rule) else rule(r) for r in rules]
    cond = url_present(url)
    if resolved:
        cond = cond & all_of(*resolved, url=url)
    return df.where(_prune(df, cond, resolved))


def select_any(df: DataFrame, *rules: Rule | str, url: str = "url") -> DataFrame:
    """Rows whose url is present and matches at least one rule."""
    resolved = [r if isinstance(r, Rule) else rule(r) for r in rules]
    return df.where(_prune(df, url_present(url) & any_of(*resolved, url=url), resolved, True))


def with_url_suffix(df: DataFrame, url: str = "url") -> DataFrame:
    """Add the suffix-class column used to partition a raw link table."""
    return df.withColumn(SUFFIX_COLUMN, url_suffix_class(url))


def jp_jpg_jpeg(df: DataFrame) -> DataFrame:
    """Japanese jpg and jpeg links, all columns.

    The two suffixes exclude each other, so one ``OR`` predicate gives the
    same rows as appending the jpg rows and then the jpeg rows, in one scan.
    """
    cond = url_present() & (JPG.column() | JPEG.column()) & JP.column()
    return df.where(_prune(df, cond, [JPG, JPEG], any_of_rules=True))


def jp_png(df: DataFrame) -> DataFrame:
    """Japanese png links, all columns."""
    return df.where(_prune(df, url_present() & PNG.column() & JP.column(), [PNG]))


def link_columns(df: DataFrame) -> DataFrame:
    """Drop the raw table's bookkeeping partition columns (run, suffix class)."""
    return df.drop(*[c for c in BOOKKEEPING_COLUMNS if c in df.columns])
