"""Quality rules: repetition by suffix array.

The words of a text are the alphabet. For a block of documents one suffix
array is built by prefix doubling (numpy; only suffixes that still tie are
sorted again), kept apart by document. Comparing the ranks kept from each
doubling, longest first, gives the longest common prefix (LCP) of
neighbouring suffixes without a loop per word. Ranks are kept only up to
``KEPT_RANKS`` numbers; beyond (a very long text that repeats itself at many
lengths) the same LCP comes from the final ranks alone, in text order, with a
loop per word and memory in proportion to the words.

The deepest LCP interval around a suffix has the greater of its two
neighbouring LCP values; that prefix is the longest repeated substring that
starts there. A maximal repeat covers what its shorter parts cover, so the
union of these spans, taken where the length is at least ``MIN_REPEAT``
words, is the union of the spans of all maximal repeats of that length.

Verdict: a text is dropped when repeats cover more than ``MAX_COVERED``
percent of its words, or the longest repeat exceeds ``MAX_LONGEST`` words.

The spans of all repeats of at least m words cover what the m-word windows
that occur twice cover, and a repeat of m words exists if such a window does;
``VERDICT_SQL`` says the same in SQL that way.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .textblocks import SEPARATORS, TextBlock, Words, blocks, hash_words, split_words

MIN_REPEAT = 5
MAX_COVERED = 40  # percent of the words
MAX_LONGEST = 100  # words
KEPT_RANKS = 16_000_000

# Fixed values of the base measures.
SYMBOLS = b"#*$%&|<>"
BASE_MIN_WORDS = 20
BASE_WINDOW = 8
BASE_REPEAT_PERCENT = 30

MEASURES = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, covered_words long, longest_repeat long")


def suffix_ranks(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray] | None]:
    """Final rank of every suffix, and the ranks by the first 1, 2, 4, ...
    words, or None where these are more than ``KEPT_RANKS``. Equal ranks mean
    equal prefixes in the same document."""
    n = len(values)
    kind = np.int32 if n < 1 << 31 else np.int64
    key = np.unique(values, return_inverse=True)[1].astype(np.int64)
    key += doc.astype(np.int64) * (int(key.max(initial=0)) + 1)
    order = np.argsort(key).astype(kind)
    key = key[order]
    head = np.ones(n, dtype=bool)
    head[1:] = key[1:] != key[:-1]
    del key
    rank = np.empty(n, dtype=kind)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=kind), 0))
    levels, width = [rank], 1
    tied = order[~(head & np.append(head[1:], True))]
    del order, head
    while len(tied):
        after = tied + kind(min(width, n))
        inside = after < n
        after[~inside] = 0
        inside &= doc[after] == doc[tied]
        after = rank[after]
        after += 1
        after[~inside] = 0
        key = rank[tied].astype(np.int64)
        key *= n + 1
        key += after
        del after, inside
        by = np.argsort(key)
        tied = tied[by]
        key = key[by]
        del by
        first = rank[tied]
        new_group = np.ones(len(tied), dtype=bool)
        new_group[1:] = first[1:] != first[:-1]
        head = np.ones(len(tied), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        del key
        at = np.arange(len(tied), dtype=kind)
        first -= np.maximum.accumulate(np.where(new_group, at, 0))
        first += np.maximum.accumulate(np.where(head, at, 0))
        del at, new_group
        if levels is not None and n * (len(levels) + 1) > KEPT_RANKS and len(levels) > 1:
            levels = None
        if levels is not None:
            rank = rank.copy()
            levels.append(rank)
        rank[tied] = first
        width *= 2
        tied = tied[~(head & np.append(head[1:], True))]
    return rank, levels


def neighbour_lcp(rank: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the LCP of each suffix with the one before it."""
    n = len(rank)
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[rank] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int64)
    if n > 1:
        a, b = suffixes[:-1].copy(), suffixes[1:].copy()
        for j in range(len(levels) - 1, -1, -1):
            same = (a < n) & (b < n)
            same[same] = levels[j][a[same]] == levels[j][b[same]]
            step = same.astype(np.int64) << j
            a += step
            b += step
        lcp[1:] = b - suffixes[1:]
    return suffixes, lcp


def lcp_in_text_order(values: np.ndarray, doc: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the final ranks alone: the LCP of a suffix with the one
    before it is at most one shorter than that of the suffix one word earlier."""
    n = len(rank)
    suffixes = np.empty(n, dtype=rank.dtype)
    suffixes[rank] = np.arange(n, dtype=rank.dtype)
    lcp = np.zeros(n, dtype=rank.dtype)
    ranks, places, out = memoryview(rank), memoryview(suffixes), memoryview(lcp)
    words, docs = memoryview(np.ascontiguousarray(values)), memoryview(np.ascontiguousarray(doc))
    h = 0
    for i in range(n):
        r = ranks[i]
        if not r:
            h = 0
            continue
        j = places[r - 1]
        if docs[j] != docs[i]:
            h = 0
            continue
        limit = n - max(i, j)
        while h < limit and words[i + h] == words[j + h] and docs[i + h] == docs[i] and docs[j + h] == docs[i]:
            h += 1
        out[r] = h
        if h:
            h -= 1
    return suffixes, lcp


def longest_repeats(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position, the words of the longest repeat that starts there."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    rank, levels = suffix_ranks(values, doc)
    suffixes, lcp = lcp_in_text_order(values, doc, rank) if levels is None else neighbour_lcp(rank, levels)
    best = lcp.copy()
    np.maximum(best[:-1], lcp[1:], out=best[:-1])
    out = np.empty(len(values), dtype=lcp.dtype)
    out[suffixes] = best
    return out


def covered(start: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n positions the spans cover."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, start, 1)
    np.subtract.at(edge, start + length, 1)
    return np.cumsum(edge[:n], dtype=np.int32) > 0


def _per_doc(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive ``first`` positions."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def _dup_lines(block: TextBlock, words: Words) -> np.ndarray:
    data, off = block.data, block.offsets
    breaks = np.flatnonzero(data == 0x0A)
    start = np.unique(np.concatenate((off[:-1], breaks + 1)))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data)) if len(start) else start
    end = end - (data[end - 1] == 0x0A) if len(end) else end
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[has_word], end[has_word]
    doc = np.searchsorted(off[1:], start, side="right")
    lines = hash_words(data, start, end, lower=False)
    order = np.lexsort((lines, doc))
    same = np.zeros(len(lines), dtype=bool)
    same[1:] = (lines[order][1:] == lines[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][same], minlength=len(block)).astype(np.int64)


def measure(block: TextBlock, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """All measures of the documents of a block."""
    data, off = block.data, block.offsets
    words = split_words(block)
    n = len(words.start)
    heads = ((data & 0xC0) != 0x80) & ~SEPARATORS[data]
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    counts = {
        "n_words": np.diff(words.first),
        "word_chars": _per_doc(heads, off),
        "n_symbols": _per_doc(symbol[data], off),
        "n_dup_lines": _dup_lines(block, words),
    }
    values = hash_words(data, words.start, words.end, lower=False)
    first, doc = words.first, words.doc.astype(np.int32)  # what is left of the words from here on
    del words, heads
    repeat = longest_repeats(values, doc)
    del values
    longest = np.zeros(len(block), dtype=np.int64)
    np.maximum.at(longest, doc, repeat)
    window = np.flatnonzero(repeat >= BASE_WINDOW)
    counts["n_repeat_words"] = _per_doc(covered(window, BASE_WINDOW, n), first)
    del window
    spans = np.flatnonzero(repeat >= min_repeat)
    counts["covered_words"] = _per_doc(covered(spans, repeat[spans], n), first)
    counts["longest_repeat"] = longest
    return counts


def _measurer(min_repeat: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at, stop, block in blocks(batch):
                found = measure(block, min_repeat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at),
                     *(pa.array(v.astype(np.int64)) for v in found.values())],
                    names=["doc_id", *found])

    return run


def repetition_measures(docs: DataFrame, min_repeat: int = MIN_REPEAT) -> DataFrame:
    """One row of measures per document row. Null and empty texts have no
    words and zero everywhere; repeated rows are measured each; other columns
    are ignored."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _measurer(min_repeat), MEASURES)


def repetition_verdict(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: int = MAX_COVERED,
                       max_longest: int = MAX_LONGEST) -> DataFrame:
    """Measures with ``base_failed`` and ``kept``."""
    m = repetition_measures(docs, min_repeat)
    failed = ((F.col("n_words") < BASE_MIN_WORDS)
              | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words")))
    repetitive = ((100 * F.col("covered_words") > max_covered * F.col("n_words"))
                  | (F.col("longest_repeat") > max_longest))
    return m.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive)


def repetition_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns and the words that maximal repeats cover."""
    return repetition_verdict(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words",
        "base_failed", "kept")


def _windows_sql(name: str, size: str) -> str:
    """Words that windows of ``size`` words cover which occur twice in a text."""
    return f"""
{name}_at AS (
  SELECT rid, i, size, count(*) OVER (PARTITION BY rid, md5(array_to_string(words[i:i + size - 1], ' '))) AS n
  FROM (SELECT rid, words, {size} AS size, unnest(range(1, n_words - {size} + 2)) AS i FROM w)),
{name} AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + size)) AS p FROM {name}_at WHERE n > 1) GROUP BY rid)"""


VERDICT_SQL = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t),
w AS (SELECT *, len(words) AS n_words FROM s),
{_windows_sql("eight", str(BASE_WINDOW))},
{_windows_sql("short", str(MIN_REPEAT))},
{_windows_sql("long", str(MAX_LONGEST + 1))},
m AS (
  SELECT doc_id, n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(eight.n, 0) AS n_repeat_words, coalesce(short.n, 0) AS covered_words,
         coalesce(long.n, 0) > 0 AS long_repeat
  FROM w LEFT JOIN eight USING (rid) LEFT JOIN short USING (rid) LEFT JOIN long USING (rid)),
b AS (
  SELECT *, n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, base_failed,
       NOT base_failed AND NOT (100 * covered_words > {MAX_COVERED} * n_words OR long_repeat) AS kept
FROM b"""
