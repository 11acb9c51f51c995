"""MinHash near-dedup with SetSketch registers.

A document's set is its distinct 5-word shingles. Register i of a sketch is
the minimum of exponentially distributed hash values over the set, on an
exponential scale and truncated: clip(floor(1 - log_b(min h_i)), 0, q + 1).
Sketches of parts of a set merge by the register-wise maximum, and with
b = 1.001 two registers are equal with probability close to the Jaccard
similarity.

1. Sketch every row; rows with equal sets form one class (set digest).
2. Band the registers of each class. Classes that share a band value are
   candidates; nothing else is compared.
3. Candidates are visited as stars, not as all pairs of a bucket: every member
   against the bucket's most popular class. Links inside a component change
   nothing, so only buckets that these links leave in several components are
   open. In an open bucket with few pairs across components each of them is
   visited. The members of all others go through an exact prefix filter: two
   sets at the threshold share a shingle among the rarest quarter of each, and
   enough lies behind the first such shingle in both. That test needs only the
   shingle, the set's size and what lies behind, so it is made once for each
   pair of these groups of rows, and only groups that pass it are spread out to
   rows. Documents that share only a common passage fail it together, however
   many they are.
4. A candidate pair is kept if the joint maximum-likelihood estimate of the
   similarity from both sketches (with the known set sizes) is not far below
   the threshold, and is then confirmed on the full sets.
5. Components come from alternating large-star and small-star steps on the
   confirmed links. A hub, a node of more than a thousandth of a step's rows,
   never comes together in one task: fewer than a thousand nodes can be hubs,
   so what their rows need is broadcast to where the rows are.

At similarity 0.75 a pair shares no band with probability
(1 - 0.75**4)**32 = 5e-6, and the estimate's margin is six standard errors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import join_path, new_work_dir
from .shipping import ship
from .textblocks import (TextBlock, blocks, hash_windows, hash_words, mix64, odd_constants,
                         split_words)

SHINGLE = 5
REGISTERS = 128
BAND = 4  # registers a band
SIMILAR, OF = 75, 100  # threshold 75 / 100
BASE, RATE, LIMIT = 1.001, 20.0, 65534
MARGIN = 0.23  # six standard errors of the estimate at the threshold
PAIRS_OF_BUCKET = 200
SHINGLE_ROW = 64
FREQUENT = 64
HUBS = 1_000  # a node of more than a HUBS-th of the rows is a hub

SIGNED = ("doc_id long, n_shingles long, digest_a long, digest_b long, registers binary")


def shingle_sets(block: TextBlock) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    words = split_words(block)
    values = hash_words(block.data, words.start, words.end, lower=True)
    at, hashes = hash_windows(values, words.doc, SHINGLE)
    first = np.searchsorted(at, words.first)
    out = []
    for i in range(len(block)):
        lo, hi = words.first[i], words.first[i + 1]
        if hi - lo >= SHINGLE:
            out.append(np.unique(hashes[first[i]:first[i + 1]]))
        elif hi > lo:  # fewer words: the whole sequence is one shingle
            _, whole = hash_windows(values[lo:hi], words.doc[lo:hi], int(hi - lo))
            out.append(mix64(whole + np.uint64(hi - lo)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


MULTIPLIERS = odd_constants(REGISTERS, 71)
LOG_BASE = np.log(BASE)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (documents x REGISTERS, 16 bits) of non-empty sets."""
    joined = np.concatenate(sets)
    heads = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), REGISTERS), dtype=np.float64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat((joined * MULTIPLIERS[i]) >> np.uint64(32), heads)
    uniform = (least + 0.5) / 2.0 ** 32
    values = -np.log1p(-uniform) / RATE
    registers = np.floor(1.0 - np.log(values) / LOG_BASE)
    return np.clip(registers, 0, LIMIT + 1).astype("<u2")


def _signer(batches):
    import pyarrow as pa

    for batch in batches:
        for at, stop, block in blocks(batch):
            sets = shingle_sets(block)
            full = [i for i, s in enumerate(sets) if len(s)]
            registers = [b""] * len(sets)
            if full:
                for i, row in zip(full, sketch([sets[i] for i in full])):
                    registers[i] = row.tobytes()
            with np.errstate(over="ignore"):
                a = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                b = np.array([np.bitwise_xor.reduce(mix64(s + np.uint64(977))) if len(s) else 0
                              for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, stop - at),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                 pa.array(registers, pa.binary())],
                names=["doc_id", "n_shingles", "digest_a", "digest_b", "registers"])


def estimate(n_a: np.ndarray, n_b: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood similarity from the number of registers of a
    above b's and below, given both set sizes. p(x) = -log_b(1 - x (b - 1) / b)
    is the chance that a register is decided by a part x of the union."""
    grid = np.linspace(0.0, 1.0, 101)[:, None]
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    most = np.minimum(u / v, v / u)
    j = grid * most

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / LOG_BASE

    up, down = p(u - v * j), p(v - u * j)
    same = np.clip(1.0 - up - down, 1e-12, None)
    likelihood = above * np.log(up) + below * np.log(down) + (REGISTERS - above - below) * np.log(same)
    return np.take_along_axis(j, likelihood.argmax(axis=0)[None, :], axis=0)[0]


def _estimator(batches):
    import pyarrow as pa

    width = 2 * REGISTERS
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names

        def column(n):
            return batch.column(names.index(n))

        ra, rb = (np.frombuffer(b"".join(column(n).to_pylist()), "<u2").reshape(-1, width // 2)
                  for n in ("ra", "rb"))
        similar = estimate(column("na").to_numpy().astype(float), column("nb").to_numpy().astype(float),
                           (ra > rb).sum(axis=1), (ra < rb).sum(axis=1))
        keep = pa.array(similar >= SIMILAR / OF - MARGIN)
        yield pa.RecordBatch.from_arrays([column("a").filter(keep), column("b").filter(keep)],
                                         names=["a", "b"])


def _confirmer(batches):
    import pyarrow as pa

    last, last_set = None, None
    for batch in batches:
        names = batch.schema.names
        a, b = (batch.column(names.index(n)).to_pylist() for n in ("a", "b"))
        keep = []
        for at, stop, block in blocks(batch, "text_b"):
            first = batch.column(names.index("text_a"))
            for i, other in zip(range(at, stop), shingle_sets(block)):
                if a[i] != last or last_set is None:
                    text = (first[i].as_py() or "").encode()
                    last_set = shingle_sets(TextBlock(np.frombuffer(text, np.uint8),
                                                      np.array([0, len(text)])))[0]
                    last = a[i]
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                if OF * both >= SIMILAR * (len(last_set) + len(other) - both):
                    keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())],
            names=["a", "b"])


class _Stored:
    """Tables of one run in the shared folder; writing one cuts the lineage."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, new_work_dir(spark, "neardup"), 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = join_path(self.root, f"{self.n:03d}-{name}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_edges(self, df: DataFrame) -> tuple[DataFrame, tuple]:
        """The table, and the number and checksum of its rows, taken as it is written."""
        seen = Observation()
        kept = self.keep(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "edges")
        return kept, (seen.get["n"], seen.get["sum"])


def _with_least(rows: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """Rows (a, b), ``n`` at the most, with the m of their a from ``least``
    (a, m, degree). Hubs' rows stay in place: fewer than HUBS nodes can have
    more than n / HUBS rows each, so their m is broadcast."""
    hubs = F.broadcast(least.where(F.col("degree") * HUBS > n).select("a", F.col("m").alias("hub_m")))
    met = rows.join(hubs, "a", "left")
    of_hubs = met.where("hub_m is not null").select("a", "b", F.col("hub_m").alias("m"))
    others = met.where("hub_m is null").join(least, "a").select("a", "b", "m")
    return of_hubs.unionByName(others)


def components(links: DataFrame, store: _Stored) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes that reach a
    smaller one."""
    edges, now = store.keep_edges(links.select("a", "b").where("a != b").distinct())
    while now[0]:
        # Large star: neighbours above a node move to the least of its neighbourhood.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = (both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
                 .select("a", F.least("a", "m").alias("m"), "degree"))
        large = store.keep(_with_least(both, least, 2 * now[0]).where("b > a and b != m")
                           .select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        # Small star: a node's smaller neighbours (here a > b always) move to the least one.
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
        small = (_with_least(large, least, now[0]).select(F.explode(F.array(
            F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a != b").distinct())
        before = now
        edges, now = store.keep_edges(small)
        if now == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _fits(na: str, nb: str):
    """Set sizes that allow the threshold."""
    return F.expr(f"{OF} * least({na}, {nb}) >= {SIMILAR} * greatest({na}, {nb})")


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, store: _Stored) -> DataFrame:
    """Confirmed links among candidate pairs (a, b) of class representatives."""
    sketches = classes.select("rep", "registers", F.col("n_shingles").alias("n"))
    sa = sketches.toDF("a", "ra", "na")
    sb = sketches.toDF("b", "rb", "nb")
    likely = pairs.join(sb, "b").join(sa, "a").mapInArrow(_estimator, "a long, b long")
    ta, tb = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    return store.keep(likely.join(tb, "b").join(ta, "a").mapInArrow(_confirmer, "a long, b long"),
                      "links")


def _shingler(batches):
    import pyarrow as pa

    for batch in batches:
        for at, stop, block in blocks(batch):
            parts = [(i, s[k:k + SHINGLE_ROW].view(np.int64))
                     for i, s in zip(range(at, stop), shingle_sets(block))
                     for k in range(0, len(s), SHINGLE_ROW)]
            rows = batch.take(pa.array([i for i, _ in parts], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.names.index(n)) for n in ("rep", "n", "component")),
                 pa.array([p for _, p in parts], pa.list_(pa.int64()))],
                names=["rep", "n", "component", "shingles"])


def _across(rows: DataFrame, key: str) -> DataFrame:
    """Pairs of equal ``key`` in different components whose sizes allow a link."""
    x, y = (rows.select(key, F.col("rep").alias(i), F.col("n").alias(f"n{i}"),
                        F.col("component").alias(f"c{i}"))
            for i in "ab")
    return x.join(y, key).where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
                                & _fits("na", "nb"))


def _by_prefix(members: DataFrame, texts: DataFrame, store: _Stored) -> DataFrame:
    """Pairs across components that share one of the rarest shingles of both:
    of n shingles, the first n - ceil(threshold * n) + 1 in an order that puts
    shingles of a single component first and then goes by frequency."""
    cut = (texts.join(members, "rep")
           .mapInArrow(_shingler, "rep long, n long, component long, shingles array<long>")
           .repartition("rep", F.element_at("shingles", 1)))  # a long text is in many parts
    shingles = store.keep(cut.select("rep", "n", "component", F.explode("shingles").alias("shingle")),
                          "shingles")
    across = store.keep(
        shingles.groupBy("shingle")
        .agg(F.count("*").alias("f"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        .where("c0 != c1").select("shingle", "f"), "across")
    room = F.expr(f"n - cast(ceil({SIMILAR} * n / {OF}) as long) + 1")
    # Frequent shingles come last in every set, so only sets made mostly of them look them up.
    cold = store.keep(shingles.join(across.where(F.col("f") <= FREQUENT), "shingle"), "cold")
    own = shingles.join(across, "shingle", "left_anti").groupBy("rep").agg(F.count("*").alias("n_own"))
    rarer = cold.groupBy("rep").agg(F.count("*").alias("n_cold"))
    sizes = store.keep(
        members.select("rep", "n").join(own, "rep", "left").join(rarer, "rep", "left")
        .select("rep", F.coalesce("n_own", F.lit(0)).alias("n_own"),
                (F.coalesce("n_own", F.lit(0)) + F.coalesce("n_cold", F.lit(0)) < room).alias("deep")),
        "sizes")
    deep = sizes.where("deep").select("rep")
    hot = (shingles.join(deep, "rep", "left_semi")
           .join(across.where(F.col("f") > FREQUENT), "shingle"))
    order = Window.partitionBy("rep").orderBy("f", "shingle")
    prefix = store.keep(
        cold.unionByName(hot).withColumn("row", F.row_number().over(order)).join(sizes, "rep")
        .withColumn("place", F.col("row") + F.col("n_own"))
        .where(F.col("place") <= room)
        .select("rep", "n", "component", "shingle", (F.col("n") - F.col("place") + 1).alias("left")),
        "prefix")
    return _of_groups(prefix)


def _of_groups(prefix: DataFrame) -> DataFrame:
    """Pairs of rows (rep, n, component, shingle, left) of one shingle, in
    different components, that can be linked: what two linked sets share lies
    at or behind their first shared place. Rows of equal (shingle, n, left)
    are one group; pairs are made from the pairs of groups that pass."""
    key = ["shingle", "n", "left"]
    groups = prefix.groupBy(*key).agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    x, y = (groups.select("shingle", *[F.col(c).alias(c + i) for c in ("n", "left", "c0", "c1")]) for i in "xy")
    enough = F.expr(f"{SIMILAR + OF} * least(leftx, lefty) >= {SIMILAR} * (nx + ny)")
    once = F.expr("nx < ny or nx = ny and leftx <= lefty")
    apart = F.expr("not (c0x = c1x and c0y = c1y and c0x = c0y)")
    live = x.join(y, "shingle").where(once & _fits("nx", "ny") & enough & apart).drop("c0x", "c1x", "c0y", "c1y")
    rows = prefix.select(*key, "rep", "component")
    a, b = (rows.select("shingle", F.col("n").alias("n" + i), F.col("left").alias("left" + i),
                        F.col("rep").alias("rep" + i), F.col("component").alias("c" + i)) for i in "xy")
    pairs = live.join(a, ["shingle", "nx", "leftx"]).join(b, ["shingle", "ny", "lefty"]).where("cx != cy")
    return pairs.select(F.least("repx", "repy").alias("a"), F.greatest("repx", "repy").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Rows without words have no shingles and are their own component. Rows
    that repeat a doc_id are one node of the graph. Rows with a null doc_id
    are linked with nothing (component_id null, kept). Other columns are
    ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    ship(spark)
    store = _Stored(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = store.keep(docs.mapInArrow(_signer, SIGNED), "signed")
    digest = ["n_shingles", "digest_a", "digest_b"]
    classes = store.keep(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy(*digest)
        .agg(F.min("doc_id").alias("rep"), F.first("registers").alias("registers")), "classes")

    step = 2 * BAND
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("registers", b * step + 1, step))
                     for b in range(REGISTERS // BAND)])
    banded = classes.select("rep", F.col("n_shingles").alias("n"), F.explode(keys).alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = store.keep(banded.join(shared, "key"), "members")
    # The texts that any comparison may need, moved once, with the same plan at every size.
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = store.keep(docs.join(wanted.hint("merge"), "doc_id", "left_semi")
                       .select(F.col("doc_id").alias("rep"), "text"), "texts")
    popular = members.groupBy("rep").agg(F.sum("size").alias("popularity"))
    ranked = members.join(popular, "rep")
    top = ranked.groupBy("key").agg(F.max(F.struct("popularity", "rep", "n")).alias("t"))
    stars = (members.join(top, "key").where((F.col("rep") != F.col("t.rep")) & _fits("n", "t.n"))
             .select(F.col("t.rep").alias("a"), F.col("rep").alias("b")).distinct())
    links = _links(stars, classes, texts, store)
    found = components(links, store)

    placed = store.keep(members.join(found, members["rep"] == found["node"], "left")
                        .select(*members.columns, F.coalesce("component", "rep").alias("component")),
                        "placed")
    total, squares = F.sum("c"), F.sum(F.col("c") * F.col("c"))
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    open_ = (parts.groupBy("key").agg(((total * total - squares) / 2).alias("pairs"))
             .where("pairs > 0"))
    rest = store.keep(placed.join(open_, "key"), "open")
    few = _across(rest.where(F.col("pairs") <= PAIRS_OF_BUCKET), "key").select("a", "b")
    many = rest.where(F.col("pairs") > PAIRS_OF_BUCKET).select("rep", "n", "component").distinct()
    more = _links(few.union(_by_prefix(many, texts, store)).distinct(), classes, texts, store)
    found = components(links.union(more), store)

    labels = (classes.join(found, classes["rep"] == found["node"], "left")
              .select(*digest, F.coalesce("component", "rep").alias("component")))
    rows = signed.select("doc_id", *digest).join(labels, digest, "left")
    own = F.when(F.col("n_shingles") > 0, F.least("component", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows, with their columns, of the documents that stay: the one with
    the smallest doc_id of each group. Rows that repeat a doc_id stay or go
    together; rows with a null doc_id stay."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


# The same result by comparing every pair that shares a shingle.
COMPONENTS_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {SHINGLE - 1}, 1) + 1)) AS i
        FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sh x JOIN sh y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE {OF} * c >= {SIMILAR} * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM w
  UNION
  SELECT b, root FROM reach JOIN edges ON a = node)
SELECT w.doc_id, coalesce(sizes.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) c ON c.node = w.doc_id"""
