"""Link selection rules held as data.

Every rule is ``lower(url) LIKE pattern``. Catalyst rewrites each pattern
into ``StartsWith`` / ``EndsWith`` / ``Contains`` and keeps the whole
predicate inside whole-stage codegen; the implied ``url IS NOT NULL``
reaches the parquet scan as a pushed filter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SUFFIX_COLUMN as _SUFFIX_COLUMN


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    kind: str  # "image" | "country" | "site"
    suffix: str | None = None  # image rules: the suffix class the url must have

    def column(self, url: str = "url") -> Column:
        return F.lower(F.col(url)).like(self.pattern)

    def sql(self, url: str = "url") -> str:
        return f"lower({url}) LIKE '{self.pattern}'"


# The selection patterns, as the source jobs define them.
# Image suffix rules (the url must end with the suffix; "http" is a text prefix).
JPG = Rule("jpg", "http%.jpg", "image", "jpg")
JPEG = Rule("jpeg", "http%.jpeg", "image", "jpeg")
PNG = Rule("png", "http%.png", "image", "png")
BMP = Rule("bmp", "http%.bmp", "image", "bmp")
# Country domain rules (".jp/" or ".kr/" anywhere in the url).
JP = Rule("jp", "%.jp/%", "country")
KR = Rule("kr", "%.kr/%", "country")
# Named Korean sites. Naver has no leading wildcard: only scheme-less urls match.
NAVER = Rule("naver", "www.naver.com/%", "site")
KAKAO = Rule("kakao", "%.kakao.com/%", "site")
DAUM = Rule("daum", "%.daum.net/%", "site")
COUPANG = Rule("coupang", "%.coupang.com/%", "site")
NATE = Rule("nate", "%.nate.com/%", "site")
CHOSUN = Rule("chosun", "%.chosun.com/%", "site")
JOINS = Rule("joins", "%.joins.com/%", "site")
MUSINSA = Rule("musinsa", "%.musinsa.com/%", "site")

IMAGE_RULES = (JPG, JPEG, PNG, BMP)
COUNTRY_RULES = (JP, KR)
SITE_RULES = (NAVER, KAKAO, DAUM, COUPANG, NATE, CHOSUN, JOINS, MUSINSA)
ALL_RULES = IMAGE_RULES + COUNTRY_RULES + SITE_RULES
RULES_BY_NAME = {rule.name: rule for rule in ALL_RULES}

# The six rules whose streams all append into the Korean link table.
KR_FAN_IN = (KR, JOINS, MUSINSA, DAUM, NATE, CHOSUN)


def rule(name: str) -> Rule:
    try:
        return RULES_BY_NAME[name]
    except KeyError:
        raise KeyError(f"unknown rule {name!r}; known: {sorted(RULES_BY_NAME)}") from None


# Optional layout of the raw table: a partition column holding the image
# suffix class of the url, so that image selections read one partition.
SUFFIX_COLUMN = _SUFFIX_COLUMN
OTHER_SUFFIX = "other"


def url_suffix_class(url: str = "url") -> Column:
    """``jpg`` / ``jpeg`` / ``png`` / ``bmp`` when the case-folded url ends with
    that suffix, else ``other`` (null urls too). Every image rule implies its
    class, so filtering on the class prunes partitions without changing rows."""
    lowered = F.lower(F.col(url))
    out = None
    for r in IMAGE_RULES:
        cond = lowered.endswith(f".{r.suffix}")
        out = F.when(cond, F.lit(r.suffix)) if out is None else out.when(cond, F.lit(r.suffix))
    return out.otherwise(F.lit(OTHER_SUFFIX))


def suffix_pruning(columns: list[str], rules, any_of_rules: bool = False) -> Column | None:
    """The suffix-class predicate implied by image rules, when the input has
    the partition column; ``None`` when there is nothing to prune."""
    if SUFFIX_COLUMN not in columns:
        return None
    suffixes = [r.suffix for r in rules if r.suffix]
    if not suffixes or (any_of_rules and len(suffixes) != len(list(rules))):
        return None
    col = F.col(SUFFIX_COLUMN)
    if any_of_rules:
        return col.isin(*suffixes)
    return reduce(lambda a, b: a & b, (col == s for s in suffixes))


def url_present(url: str = "url") -> Column:
    return F.col(url).isNotNull()


def all_of(*rules: Rule, url: str = "url") -> Column:
    return reduce(lambda a, b: a & b, (r.column(url) for r in rules))


def any_of(*rules: Rule, url: str = "url") -> Column:
    return reduce(lambda a, b: a | b, (r.column(url) for r in rules))


def matching_rule_names(rules: tuple[Rule, ...] | list[Rule], url: str = "url") -> Column:
    """Array of the names of every rule the url matches (maybe empty).

    One pass over the data evaluates all rules; exploding this array gives
    one row per (link, matching rule), which is what several append-only
    streams into one table produce.
    """
    tagged = F.array(*[F.when(r.column(url), F.lit(r.name)) for r in rules])
    return F.filter(tagged, lambda x: x.isNotNull())
