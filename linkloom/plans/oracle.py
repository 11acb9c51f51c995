"""DuckDB twins of the derived inputs, as SQL text.

Used only to check results: each string runs on the driver tables
registered as views (``pages``, ``lineitem``, ``orders``, ...).
"""

from __future__ import annotations

from ..sources.derived import (ANCHOR_PATTERN, ANCHOR_TEXT_PATTERN, FILE_SUFFIXES, HREF_PATTERN,
                               LINK_PATH, SITE_SUFFIXES)


def _case(expr: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} {arms} ELSE '{values[-1]}' END"


PAGE_LINKS = f"""
SELECT page_id,
       regexp_extract(anchor, '{HREF_PATTERN}', 1) AS url,
       regexp_extract(anchor, '{ANCHOR_TEXT_PATTERN}', 1) AS text
FROM (SELECT page_id, unnest(regexp_extract_all(html, '{ANCHOR_PATTERN}', 0)) AS anchor
      FROM pages)
"""

WAT_LINKS = f"""
SELECT '{LINK_PATH}' AS path, CAST(NULL AS VARCHAR) AS target, text,
       CAST(NULL AS VARCHAR) AS title, url
FROM ({PAGE_LINKS})
"""

SYNTHETIC_URL = f"""
CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE
  (CASE WHEN l_linenumber % 5 = 0 THEN '//'
        WHEN l_linenumber % 5 = 1 THEN 'www.naver.com/' ELSE 'https://' END)
  || 'H' || CAST(l_suppkey % 7 AS VARCHAR)
  || {_case('l_suppkey % 9', SITE_SUFFIXES)}
  || (CASE WHEN l_partkey % 11 = 0 THEN 'x.kr/' ELSE '' END)
  || CAST(l_partkey AS VARCHAR)
  || {_case('l_orderkey % 6', FILE_SUFFIXES)}
END"""

SYNTHETIC_LINKS = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       '{LINK_PATH}' AS path, CAST(NULL AS VARCHAR) AS target, l_returnflag AS text,
       CAST(NULL AS VARCHAR) AS title, {SYNTHETIC_URL} AS url
FROM lineitem
"""

WARC_NAMES = """
SELECT o_orderkey,
       'crawl-data/CC-MAIN-2023-14/segments/' || CAST(o_custkey % 5 AS VARCHAR)
       || '/warc/CC-MAIN-' || CAST(o_orderkey AS VARCHAR) || '.warc.gz' AS warc_filename
FROM orders
"""

WARC_NAMES_FETCHED = WARC_NAMES.replace("FROM orders", "FROM orders WHERE o_orderstatus = 'F'")


def wat_url_sql(col: str) -> str:
    return (f"'https://data.commoncrawl.org/' || regexp_replace(regexp_replace({col}, '/warc/', '/wat/', 'g'),"
            f" '\\.warc', '.warc.wat', 'g')")


# Fixed values, written out a second time so that a mistyped rule shows up.
PATTERNS = {
    "jpg": "http%.jpg", "jpeg": "http%.jpeg", "png": "http%.png", "bmp": "http%.bmp",
    "jp": "%.jp/%", "kr": "%.kr/%",
    "naver": "www.naver.com/%", "kakao": "%.kakao.com/%", "daum": "%.daum.net/%",
    "coupang": "%.coupang.com/%", "nate": "%.nate.com/%", "chosun": "%.chosun.com/%",
    "joins": "%.joins.com/%", "musinsa": "%.musinsa.com/%",
}
FAN_IN = ("kr", "joins", "musinsa", "daum", "nate", "chosun")


def rule_sql(rule, url: str = "url") -> str:
    """The predicate of a rule (or its name)."""
    return f"lower({url}) LIKE '{PATTERNS[getattr(rule, 'name', rule)]}'"


def fan_in_sql(source: str, rules=FAN_IN, keep: str = "url") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{r}' AS rule, {keep} FROM ({source}) WHERE {rule_sql(r)}" for r in rules)
