"""File-name and path rewrites as Spark column expressions.

All of them are built-in JVM expressions (regexp_replace / regexp_extract /
concat), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public download prefix of the crawl archive and the two
# rewrites that turn a WARC file name into its WAT (metadata) file name.
WAT_URL_PREFIX = "https://data.commoncrawl.org/"
WARC_DIR_PATTERN = r"/warc/"
WAT_DIR = "/wat/"
WARC_SUFFIX_PATTERN = r"\.warc"
WAT_SUFFIX = ".warc.wat"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def warc_dir_to_wat(c: Column | str) -> Column:
    """Every ``/warc/`` becomes ``/wat/``."""
    return F.regexp_replace(_col(c), WARC_DIR_PATTERN, WAT_DIR)


def warc_suffix_to_wat(c: Column | str) -> Column:
    """Every ``.warc`` becomes ``.warc.wat`` (not idempotent, as in the source)."""
    return F.regexp_replace(_col(c), WARC_SUFFIX_PATTERN, WAT_SUFFIX)


def with_prefix(c: Column | str, prefix: str = WAT_URL_PREFIX) -> Column:
    """``prefix || c``; null stays null."""
    return F.concat(F.lit(prefix), _col(c))


def warc_name_to_wat_url(c: Column | str, prefix: str = WAT_URL_PREFIX) -> Column:
    return with_prefix(warc_suffix_to_wat(warc_dir_to_wat(c)), prefix)


def warc_to_wat(df: DataFrame, source: str = "warc_filename", target: str = "full_wat_path",
                prefix: str = WAT_URL_PREFIX) -> DataFrame:
    """Replace the WARC name column by the WAT url, placed last.

    Other columns pass through in their order.
    """
    keep = [F.col(f"`{name}`") for name in df.columns if name != source]
    return df.select(*keep, warc_name_to_wat_url(source, prefix).alias(target))


# Both patterns end with ``\z`` (end of input): Java's ``$`` also matches
# before a final line break, which would pick an earlier part of "a/\n".


def file_name_of_url(c: Column | str) -> Column:
    """Text after the last ``/``; empty when there is no ``/`` or it is last.

    The query string is kept.
    """
    return F.regexp_extract(_col(c), r"/([^/]*)\z", 1)


def file_name_of_path(c: Column | str) -> Column:
    """Last non-empty ``/``-separated part: no slash keeps the text, a trailing
    slash is ignored; text made only of slashes gives an empty string."""
    return F.regexp_extract(_col(c), r"([^/]+)/*\z", 1)


def is_count_arg(text: str) -> bool:
    """Command-line check for a file count argument (digits only)."""
    return bool(re.fullmatch(r"\d+", text or ""))
