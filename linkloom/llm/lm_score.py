"""LM scoring: weighted backoff automaton.

The model is an n-gram model with hierarchical Dirichlet smoothing,

    P1(w)     = (c(w) + ADD) / (N + ADD (V + 1))
    Pk(w | h) = (c(h w) + m_k P(k-1)(w | h')) / (c(h) + m_k)

where h' is h without its first token and m_k is learned: the mean number of
different continuations of a context. As an automaton, a state is a context
seen in training; its arcs are the tokens seen behind it, weighted with
log10 Pk; its failure arc leads to the state of h', weighted with
log10 m_k / (c(h) + m_k). The root has an arc for every token, also unknown
ones. A text is scored in one traversal from the state of a text's beginning.

The counts cover every training text and are never in one place. A task cuts
its texts into blocks of about ``BLOCK_TEXT`` bytes and numbers the words of
each. A block sends its different n-grams, with their training counts, to
shards by ranges of their hash; a shard adds up what all blocks send and
answers each block with the totals of its n-grams. The block then builds the
part of the automaton that its texts can reach, and traverses it. So a task
holds one block or one shard of a bounded size: a frequent n-gram comes once
from each block, whatever its count is, and the number of shards follows the
number of tokens.

n-grams are told apart by 64-bit hashes: of n different ones about n**2 / 4e19
pairs collide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .store import Store
from .textblocks import TextBlock, blocks, hash_words, mix64, odd_constants, split_words

ORDER = 2
ADD = 0.1
BLOCK_TEXT = 4_000_000
SHARD_GRAMS = 2_000_000
END, BEGIN = (int(v) for v in odd_constants(2, 101))  # hashes of the two marks
FACTORS = odd_constants(2, 113)

BLOCKS = "block long, ids array<long>, words binary, tokens binary, lengths binary, learn binary, n_tokens long"
SENT = "gram int, shard int, block long, hashes binary, counts binary"
ANSWERS = "gram int, shard int, block long, totals binary, tokens long, types long"
SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(values: np.ndarray) -> bytes:
    """Byte planes of unsigned integers, compressed; planes of zeros cost nothing."""
    import zstandard

    width = values.dtype.itemsize
    planes = values.view(np.uint8).reshape(-1, width).T if len(values) else np.zeros((width, 0), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes, dtype) -> np.ndarray:
    import zstandard

    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


@dataclass
class Tokens:
    """A block's token sequences: BEGIN, the words and END of each document.

    words: hash of each token number; the last two are END and BEGIN."""

    words: np.ndarray
    tokens: np.ndarray
    first: np.ndarray  # first[i]:first[i + 1] is document i
    learn: np.ndarray  # of each document

    @property
    def end(self) -> int:
        return len(self.words) - 2

    @property
    def begin(self) -> int:
        return len(self.words) - 1


def tokenise(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words, frequent ones first; the number of each
    word in text order; words of each document."""
    found = split_words(block)
    hashes = hash_words(block.data, found.start, found.end, lower=True)
    words, number, often = np.unique(hashes, return_inverse=True, return_counts=True)
    order = np.argsort(-often, kind="stable")
    place = np.empty(len(words), np.uint32)
    place[order] = np.arange(len(words), dtype=np.uint32)
    return words[order], place[number], np.diff(found.first).astype(np.uint32)


def sequences(words: np.ndarray, numbers: np.ndarray, lengths: np.ndarray, learn: np.ndarray) -> Tokens:
    first = np.concatenate(([0], np.cumsum(lengths.astype(np.int64) + 2)))
    tokens = np.empty(first[-1], np.int64)
    inner = np.ones(len(tokens), dtype=bool)
    inner[first[:-1]] = inner[first[1:] - 1] = False
    tokens[inner] = numbers
    tokens[first[:-1]], tokens[first[1:] - 1] = len(words) + 1, len(words)
    return Tokens(np.append(words, np.array([END, BEGIN], np.uint64)), tokens, first, learn)


@dataclass
class Grams:
    """The different k-grams of a block: hash, context (a (k-1)-gram), last
    word and one place; ``at`` has the k-gram that ends at each place, or -1."""

    hashes: np.ndarray
    context: np.ndarray
    word: np.ndarray
    place: np.ndarray
    at: np.ndarray


def grams(t: Tokens, order: int) -> list[Grams]:
    n = len(t.words)
    every = np.arange(n)
    place = np.zeros(n, np.int64)
    place[t.tokens] = np.arange(len(t.tokens))
    out = [Grams(t.words, np.zeros(n, np.int64), every, place, t.tokens)]
    starts = np.zeros(len(t.tokens), dtype=bool)
    starts[t.first[:-1]] = True
    for k in range(1, order):
        before = out[-1].at
        ends = np.flatnonzero(~starts[1:] & (before[:-1] >= 0)) + 1  # no k-gram ends at BEGIN
        key = before[ends - 1] * n + t.tokens[ends]
        different, one, which = np.unique(key, return_index=True, return_inverse=True)
        at = np.full(len(t.tokens), -1, np.int64)
        at[ends] = which
        context, word = different // n, different % n
        with np.errstate(over="ignore"):
            hashes = mix64(out[-1].hashes[context] * FACTORS[0] + t.words[word] * FACTORS[1] + np.uint64(k))
        out.append(Grams(hashes, context, word, ends[one], at))
    return out


def trained(t: Tokens, g: Grams) -> np.ndarray:
    """How often each k-gram stands in the block's training documents."""
    mine = np.repeat(t.learn, np.diff(t.first)) & (g.at >= 0)
    return np.bincount(g.at[mine], minlength=len(g.hashes)).astype(np.uint32)


def shard_cuts(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    """Where each shard's range begins in sorted hashes."""
    bounds = np.array([(i << 64) // n_shards for i in range(n_shards)], np.uint64)
    return np.append(np.searchsorted(hashes, bounds), len(hashes))


def _encoder(batches):
    block_id = TaskContext.get().partitionId() << 32
    kind = ["block", "ids", "words", "tokens", "lengths", "learn", "n_tokens"]
    for batch in batches:
        ids, learn = (batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "learn"))
        for at, stop, block in blocks(batch, target=BLOCK_TEXT):
            words, numbers, lengths = tokenise(block)
            flags = learn.slice(at, stop - at).to_numpy(zero_copy_only=False).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block_id], pa.int64()), pa.array([ids.slice(at, stop - at).to_pylist()], pa.list_(pa.int64())),
                 *(pa.array([pack(x)], pa.binary()) for x in (words, numbers, lengths, flags)),
                 pa.array([len(numbers) + len(lengths)], pa.int64())], names=kind)
            block_id += 1


def _read(row: dict) -> Tokens:
    return sequences(unpack(row["words"], np.uint64), unpack(row["tokens"], np.uint32),
                     unpack(row["lengths"], np.uint32), unpack(row["learn"], np.uint8).astype(bool))


def _sender(order: int, n_shards: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                t = _read(row)
                for k, g in enumerate(grams(t, order), 1):
                    by = np.argsort(g.hashes)
                    hashes, counts = g.hashes[by], trained(t, g)[by]
                    cuts = shard_cuts(hashes, n_shards)
                    rows = [(s, a, b) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                    steps = np.diff(hashes, prepend=np.uint64(0))
                    steps[[a for _, a, _ in rows]] = hashes[[a for _, a, _ in rows]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k] * len(rows), pa.int32()), pa.array([s for s, _, _ in rows], pa.int32()),
                         pa.array([row["block"]] * len(rows), pa.int64()),
                         pa.array([pack(steps[a:b]) for _, a, b in rows], pa.binary()),
                         pa.array([pack(counts[a:b]) for _, a, b in rows], pa.binary())],
                        names=["gram", "shard", "block", "hashes", "counts"])

    return run


def _shard(table: pa.Table) -> pa.Table:
    """Adds up the counts of one shard and answers every block; one more row
    without a block has the shard's tokens and different n-grams."""
    sent = [np.cumsum(unpack(raw, np.uint64), dtype=np.uint64) for raw in table.column("hashes").to_pylist()]
    counts = [unpack(raw, np.uint32) for raw in table.column("counts").to_pylist()]
    cuts = np.cumsum([0] + [len(s) for s in sent])
    joined = np.concatenate(sent)
    by = np.argsort(joined, kind="stable")
    head = np.diff(joined[by], prepend=np.uint64(0)) != 0
    head[0] = True
    totals = np.add.reduceat(np.concatenate(counts)[by].astype(np.uint64), np.flatnonzero(head))
    each = np.empty(len(joined), np.uint64)
    each[by] = totals[np.cumsum(head) - 1]
    words = joined[by][head] != np.uint64(BEGIN)  # a mark, not a token
    n = len(sent)
    gram, shard = table.column("gram")[0].as_py(), table.column("shard")[0].as_py()
    return pa.table({
        "gram": pa.array([gram] * (n + 1), pa.int32()), "shard": pa.array([shard] * (n + 1), pa.int32()),
        "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
        "totals": pa.array([*(pack(each[a:b]) for a, b in zip(cuts, cuts[1:])), None], pa.binary()),
        "tokens": pa.array([*[None] * n, int(totals[words].sum())], pa.int64()),
        "types": pa.array([*[None] * n, int(np.count_nonzero(totals[words]))], pa.int64())})


@dataclass
class Model:
    """What holds for the whole corpus: tokens, different words, and the weight
    m_k of the lower order for k = 2, 3, ..."""

    tokens: int
    words: int
    lower: tuple[float, ...] = ()

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADD) / (self.tokens + ADD * (self.words + 1))


@dataclass
class Automaton:
    """States, arcs and failure arcs that the texts of a block can reach.

    An arc is found by state * n_words + word."""

    n_words: int
    arcs: dict[int, int]
    weight: list[float]
    target: list[int]
    fail: list[int]
    fail_weight: list[float]
    start: int

    def score(self, tokens: list[int]) -> float:
        """Log-probability of a token sequence, in one pass from left to right."""
        arcs, n_words, weight, target = self.arcs, self.n_words, self.weight, self.target
        state, total = self.start, 0.0
        for word in tokens:
            arc = arcs.get(state * n_words + word)
            while arc is None:
                total += self.fail_weight[state]
                state = self.fail[state]
                arc = arcs.get(state * n_words + word)
            total += weight[arc]
            state = target[arc]
        return total


def automaton(t: Tokens, found: list[Grams], totals: list[np.ndarray], model: Model) -> Automaton:
    """``totals``: training counts of each order's n-grams. State 0 is the root."""
    n, order = len(t.words), len(found)
    keys, weights, targets = [np.arange(n)], [model.unigram(totals[0])], [np.zeros(n, np.int64)]
    states = [np.zeros(1, np.int64)]  # state of each k-gram, 0 without one
    fail, fail_weight = [np.zeros(1, np.int64)], [np.zeros(1)]
    n_states, lower = 1, weights[0]
    for k in range(1, order + 1):
        g, count = found[k - 1], totals[k - 1]
        seen = count > 0
        shorter = found[k - 2].at[g.place] if k > 1 else np.zeros(n, np.int64)  # the k-gram's last k - 1 tokens
        state = np.zeros(len(count), np.int64)
        if k < order:
            here = np.flatnonzero(seen & (g.word != t.end))
            state[here] = n_states + np.arange(len(here))
            n_states += len(here)
            fail.append(states[k - 1][shorter[here]])
            m = model.lower[k - 1]
            fail_weight.append(np.log10(m / (count[here] + m)))
        if k > 1:
            m = model.lower[k - 2]
            lower = (count + m * lower[shorter]) / (totals[k - 2][g.context] + m)
            keys.append(states[k - 1][g.context][seen] * n + g.word[seen])
            weights.append(lower[seen])
            targets.append(np.where(state > 0, state, states[k - 1][shorter])[seen])
        else:
            targets[0] = state
        states.append(state)
    key = np.concatenate(keys).tolist()
    return Automaton(n, dict(zip(key, range(len(key)))), np.log10(np.concatenate(weights)).tolist(),
                     np.concatenate(targets).tolist(), np.concatenate(fail).tolist(),
                     np.concatenate(fail_weight).tolist(), int(states[1][t.begin]) if order > 1 else 0)


def _scorer(order: int, model: Model):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        t = _read(row)
        found = grams(t, order)
        answers = {(a["gram"], a["shard"]): a["totals"] for a in right.select(["gram", "shard", "totals"]).to_pylist()}
        totals = []
        for k, g in enumerate(found, 1):
            mine = [unpack(answers[key], np.uint64) for key in sorted(answers) if key[0] == k]
            count = np.zeros(len(g.hashes))
            if mine:
                count[np.argsort(g.hashes)] = np.concatenate(mine)
            totals.append(count)
        machine = automaton(t, found, totals, model)
        base = np.log10(model.unigram(totals[0]))[t.tokens]
        known = (totals[0] > 0)[t.tokens]
        first, tokens = t.first, t.tokens.tolist()
        spans = [(a + 1, b) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]  # without BEGIN
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()),
            "n_tokens": pa.array([b - a for a, b in spans], pa.int64()),
            "n_known": pa.array([int(np.count_nonzero(known[a:b])) for a, b in spans], pa.int64()),
            "train_tokens": pa.array([model.tokens] * len(spans), pa.int64()),
            "base_score": pa.array([float(base[a:b].sum()) for a, b in spans], pa.float64()),
            "score": pa.array([machine.score(tokens[a:b]) for a, b in spans], pa.float64())})

    return run


def held_out(doc_id) -> Column:
    """Rows that training never sees."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0


def score_texts(docs: DataFrame, learn: Column, order: int = ORDER, shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every
    row, by a model of the rows where ``learn`` is true (null is not).

    Tokens are the words in lower case (A-Z only) and one end; a null or empty
    text is its end alone. Repeated rows count and are scored each. Without
    training rows nothing is known, and every token has probability 1 (the one
    unknown word). Other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    ship(spark)
    store = Store(spark, "lm")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    kept = store.keep(rows.mapInArrow(_encoder, BLOCKS), "blocks")
    n_tokens = kept.agg(F.sum("n_tokens")).first()[0] or 0
    n_shards = 1 + int(n_tokens) // shard_grams
    answers = store.keep(kept.select("block", "words", "tokens", "lengths", "learn")
                         .mapInArrow(_sender(order, n_shards), SENT)
                         .groupBy("gram", "shard").applyInArrow(_shard, ANSWERS), "answers")
    sums = {r["gram"]: r for r in  # one row for each order
            answers.where("block is null").groupBy("gram").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"))
            .collect()}
    types = [sums[k]["types"] if k in sums else 0 for k in range(1, order + 1)]
    # The text's beginning is a context too; an end is none.
    model = Model(sums[1]["tokens"] if sums else 0, types[0], tuple(max(b, 1) / max(a, 1) for a, b in zip(types, types[1:])))
    return (kept.drop("n_tokens").groupBy("block").cogroup(answers.where("block is not null").groupBy("block"))
            .applyInArrow(_scorer(order, model), SCORES))


def score_digest(docs: DataFrame) -> DataFrame:
    """Scores by a model of the rows that are not held out. A row with a null
    doc_id is neither held out nor learned from."""
    scored = score_texts(docs, ~held_out(F.col("doc_id")))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "n_tokens",
                         "n_known", "train_tokens", "base_score", "score")
