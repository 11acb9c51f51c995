"""Source divergence audit: token-start pointer sort.

A task builds pointers to the starts of the terms in its Arrow text buffers
and sorts the pointers of a slice by multikey quicksort: one step orders the
pointers of a run by their next eight bytes, runs that stay equal go one step
deeper. What is equal in the end is a run of one term; its pointers give the
term's occurrences and documents in every (lang, source) group of the slice.
Only these counts are shuffled, never texts.

A language keeps the terms in at least ``MIN_DOCS`` of its documents. A group
gives a kept term the share p = 1 + floor(10**9 (count + 1) / (N + V)), N being
its occurrences of kept terms and V the number of kept terms. The divergence
of p from q adds up f = floor((p - q)**2 / q) over the kept terms.

Two sources of a language are compared term by term only where both have the
term: with p0, q0 for a count of 0 the sum over all kept terms is

    sum over shared terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    + sum over the first's terms of f(p, q0) + sum over the second's of f(p0, q)
    + f(p0, q0) * (V - terms of the first - terms of the second)

The second line needs only how often each count occurs in a source. The first
is added up inside the tasks, so no pairs are shuffled but one sum for each
pair and task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shipping import ship
from .store import Store
from .textblocks import TextBlock, blocks, split_words

MIN_DOCS = 3
TERM_RANKS = 200
SHARE = 1_000_000_000
SLICE_BYTES = 4_000_000
STEP = 8  # bytes a sorting step looks at
DEEP = 64  # runs longer than this are told apart as byte strings
SALTS = 32
PAIRS = 1_000_000  # pairs a task looks at together
SUMS = 1_000_000  # sums a task holds before it passes them on

GAPS = np.ones(256, dtype=bool)
GAPS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

COUNTS = "lang string, source string, term string, n long, docs long"
JOINT = "lang string, source string, other string, value long"


def sort_pointers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms data[start:end] in byte order, equal ones in the order given,
    and which of them begin a run of equal terms. Terms hold no byte 0."""
    n = len(start)
    order = np.arange(n)
    head = np.zeros(n, dtype=bool)
    head[:1] = True
    padded = np.append(data, np.zeros(DEEP + STEP, np.uint8))
    at, run = np.arange(n), np.zeros(n, dtype=np.int64)  # places still open, and their runs
    for depth in range(0, DEEP, STEP):
        if not len(at):
            return order, head
        mine = order[at]
        first, left = start[mine] + depth, end[mine] - start[mine] - depth
        key = np.zeros(len(at), dtype=np.uint64)
        for j in range(STEP):
            key = key << np.uint64(8) | np.where(left > j, padded[np.minimum(first + j, len(data))], 0).astype(np.uint64)
        by = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, run))
        key, run = key[by], run[by]
        order[at] = mine[by]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        head[at] |= new
        # A run of one is settled, and so is one whose terms have ended.
        alone = new & np.append(new[1:], True)
        still = ~alone & (key & np.uint64(0xFF) != 0)
        run = (np.cumsum(new) - 1)[still]
        at = at[still]
    for places in np.split(at, np.flatnonzero(np.diff(run)) + 1) if len(at) else ():
        texts = [data[start[i]:end[i]].tobytes() for i in order[places]]
        by = sorted(range(len(texts)), key=texts.__getitem__)
        order[places] = order[places][by]
        head[places[1:]] = [texts[a] != texts[b] for a, b in zip(by, by[1:])]
    return order, head


def slice_counts(block: TextBlock, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a block; then, for each term and group of documents that has
    it: the term's place, the group, occurrences and documents."""
    data = LOWER[block.data]
    words = split_words(TextBlock(data, block.offsets), GAPS)
    order, head = sort_pointers(data, words.start, words.end)
    doc = words.doc[order]
    term = np.cumsum(head) - 1
    first = order[head]
    lengths = words.end[first] - words.start[first]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - words.start[first], lengths)
    terms = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)),
                                             pa.py_buffer(data[inside].tobytes()))
    # Pointers of a run are in page order, so a document's are side by side.
    new_doc = head.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    n_groups = int(group.max()) + 1 if len(group) else 1
    key = term * n_groups + group[doc]
    by = np.argsort(key, kind="stable")
    at = np.flatnonzero(np.diff(key[by], prepend=-1))
    n = np.diff(np.append(at, len(by)))
    docs = np.add.reduceat(new_doc[by].astype(np.int64), at) if len(at) else n
    key = key[by][at]
    return terms, key // n_groups, key % n_groups, n, docs


def _counter(batches):
    names = ["lang", "source", "term", "n", "docs"]
    for batch in batches:
        lang, source = (batch.column(i).dictionary_encode() for i in (0, 1))
        n_sources = max(1, len(source.dictionary))
        both = (lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n_sources
                + source.indices.to_numpy(zero_copy_only=False))

        def columns(group):
            return [lang.dictionary.take(pa.array(group // n_sources)), source.dictionary.take(pa.array(group % n_sources))]

        for at, stop, block in blocks(batch, target=SLICE_BYTES):
            groups, group, docs = np.unique(both[at:stop], return_inverse=True, return_counts=True)
            # A row without a term for each group says that it occurs.
            yield pa.RecordBatch.from_arrays(
                [*columns(groups), pa.nulls(len(groups), pa.string()), pa.array(np.zeros(len(groups), np.int64)),
                 pa.array(docs.astype(np.int64))], names=names)
            terms, term, of, n, docs = slice_counts(block, group)
            for k in range(0, len(term), 200_000):
                part = slice(k, k + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [*columns(groups[of[part]]), terms.take(pa.array(term[part])).cast(pa.string()),
                     pa.array(n[part].astype(np.int64)), pa.array(docs[part].astype(np.int64))], names=names)


def _f(p, q):
    return (p - q) ** 2 // q


def _joint(batches):
    """Sums of the terms that two sources of a language share."""
    sums: dict[tuple[str, str, str], int] = {}

    def out():
        keys = list(sums)
        got = pa.RecordBatch.from_arrays(
            [*(pa.array([k[i] for k in keys], pa.string()) for i in range(3)),
             pa.array([sums[k] for k in keys], pa.int64())], names=["lang", "source", "other", "value"])
        sums.clear()
        return got

    for batch in batches:
        found = batch.column(1)
        entries = found.flatten()
        counts = np.diff(found.offsets.to_numpy())
        source = entries.field("source").dictionary_encode()
        lang = batch.column(0).dictionary_encode()
        langs, names = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
        s = source.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        p, p0 = (entries.field(c).to_numpy(zero_copy_only=False) for c in ("p", "p0"))
        size = np.repeat(counts, counts)  # of each entry's term
        head = np.repeat(np.cumsum(counts) - counts, counts)
        of_lang = np.repeat(lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts)
        upto, at = np.cumsum(size), 0
        while at < len(s):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
            m = size[at:stop]
            i = np.repeat(np.arange(at, stop), m)
            j = np.arange(len(i)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(head[at:stop], m)
            i, j = i[i != j], j[i != j]
            value = _f(p[i], p[j]) - _f(p[i], p0[j]) - _f(p0[i], p[j]) + _f(p0[i], p0[j])
            key = (of_lang[i] * len(names) + s[i]) * len(names) + s[j]
            by = np.argsort(key, kind="stable")
            begins = np.flatnonzero(np.diff(key[by], prepend=-1))
            if len(begins):
                for k, v in zip(key[by][begins].tolist(), np.add.reduceat(value[by], begins).tolist()):
                    rest, other = divmod(k, len(names))
                    place = langs[rest // len(names)], names[rest % len(names)], names[other]
                    sums[place] = sums.get(place, 0) + v
            at = stop
            if len(sums) > SUMS:
                yield out()
    yield out()


def _share(count: str, total: str) -> Column:
    return F.expr(f"1 + (cast(cast({count} + 1 as decimal(20, 0)) * {SHARE} as decimal(38, 0)) div ({total}))")


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _sum(value: Column) -> Column:
    return F.sum(value.cast("decimal(38, 0)"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: the divergence of every (lang, source) group from each other
    source of its language. Part ``term``: the kept terms that the group uses
    more than its language, the first ``term_ranks``. Ranks go by value
    descending, then item ascending by its UTF-8 bytes.

    Null text, lang and source count as ''. Every row is a document, also one
    that repeats a doc_id or a text. A group without terms takes part in the
    pairs; in a language without kept terms all pairs are 0. Other columns are
    ignored; an empty table gives no rows. Texts are read whole, of any length."""
    spark = docs.sparkSession
    ship(spark)
    store = Store(spark, "divergence")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = store.keep(rows.mapInArrow(_counter, COUNTS).groupBy("lang", "source", "term")
                        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    # One entry for each source of a term: counts of a group are added up before.
    terms = store.keep(
        counts.where("term is not null").groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("found"))
        .where(F.col("docs") >= min_docs).drop("docs"), "terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    held = (terms.select("lang", F.explode("found").alias("x")).groupBy("lang", "x.source")
            .agg(F.count("*").alias("n_terms"), F.sum("x.n").alias("total")))
    zero = F.lit(0).cast("long")
    groups = store.keep(
        counts.where("term is null").select("lang", "source")
        .join(held, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(F.col(c), zero).alias(c) for c in ("v", "n_terms", "total", "lang_total")])
        .withColumn("p0", F.when(F.col("v") > 0, _share("0L", "total + v")).otherwise(F.lit(1).cast("long"))), "groups")
    # Spark broadcasts the groups where the table it has read is small, else it splits skewed joins.
    shares = store.keep(
        terms.select("lang", "term", "lang_n", F.explode("found").alias("x"))
        .select("lang", "term", "lang_n", F.col("x.source").alias("source"), F.col("x.n").alias("n"))
        .join(groups.select("lang", "source", "v", "total", "lang_total", "p0"), ["lang", "source"])
        .select("lang", "term", "source", "p0", _share("n", "total + v").alias("p"),
                _share("lang_n", "lang_total + v").alias("q")), "shares")

    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    salted = Window.partitionBy("lang", "source", "salt").orderBy(F.desc("value"), "item")
    over = (shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         _divergence("p", "q").alias("value"),
                                         F.pmod(F.xxhash64("term"), F.lit(SALTS)).alias("salt"))
            .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= term_ranks).drop("salt")
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= term_ranks))

    joint = (shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("found"))
             .where("size(found) > 1").select("lang", "found").mapInArrow(_joint, JOINT)
             .groupBy("lang", "source", "other").agg(_sum(F.col("value")).alias("joint")))
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"), F.col("n_terms").alias("other_terms"))
    pairs = groups.join(others, "lang").where("source != other")
    often = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("c"))
    apart = (often.join(others, "lang").where("source != other").groupBy("lang", "source", "other")
             .agg(_sum(F.col("c") * _divergence("p", "q0")).alias("there"),
                  _sum(F.col("c") * _divergence("q0", "p")).alias("back")))
    back = apart.select("lang", F.col("source").alias("other"), F.col("other").alias("source"), "back")
    key = ["lang", "source", "other"]
    value = (F.coalesce("joint", zero) + F.coalesce("there", zero) + F.coalesce("back", zero)
             + _divergence("p0", "q0") * F.expr("v - n_terms - other_terms"))
    between = (pairs.join(apart.drop("back"), key, "left").join(back, key, "left").join(joint, key, "left")
               .select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
                       value.cast("long").alias("value"))
               .withColumn("rank", F.row_number().over(own)))
    return between.unionByName(over)


DIVERGENCE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n, l.total AS lang_total, l.v,
         1 + CAST({SHARE} AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(t.total, 0) + l.v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
between_ AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
q AS (SELECT *, 1 + CAST({SHARE} AS HUGEINT) * (lang_n + 1) // (lang_total + v) AS q FROM p WHERE n > 0),
over_ AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM q WHERE p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM between_ UNION ALL SELECT * FROM over_))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}"""
