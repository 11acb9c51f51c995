"""Toxicity: multiple-instance learning with noisy-or.

A document is a bag of sentences. A sentence's score is logistic in hashed
features of its words (the word and its beginnings, so that inflected forms
share evidence), less a background share: with s = 1 / (1 + exp(-z)),

    p = max(0, s - BACKGROUND) / (1 - BACKGROUND),

and 0 for a sentence without any learned feature. The document's score is the
noisy-or of all its sentences, 1 - prod(1 - p) / (1 - leak)**n, at least 0, in
scoring and verdict alike: several middling sentences make a toxic text. The
leak is what a sentence of clean texts adds by chance, measured on every
``CALIBRATE``-th clean text of the sample, which the fit does not see; it is
some 1e-4, so it matters only in texts of thousands of sentences, which would
turn toxic by their length alone. Only documents carry
labels: the gradient of the document's likelihood reaches each sentence in
proportion to its share of the blame, so the model learns which sentences
offend and can point at them. The background grows from 0 in the first epochs,
so that every feature is weighed before sentences fall silent.

Training takes a bounded sample of labelled rows: up to ``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` documents of each class by hash order, of at most
``SAMPLE_CHARS`` characters (so that long clean texts are learned from too), one
row for each doc_id, re-weighted to the classes' true shares. Scoring reads
every whole text, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .textblocks import (BLOCK_BYTES, BYTE_POWERS, BYTE_VALUES, TextBlock, blocks, hash_words, mix64,
                         split_words)

SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 2_000, 4_000, 100_000
BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6, 7)  # bytes of a word's beginning
SENTENCE_WORDS = 25  # longer runs without a sentence end are cut
LEAST_TEXTS = 4  # a feature in fewer training texts is ignored
LEAST_Z = 6.0  # least enrichment of a feature among toxic texts, in standard errors
LEAST_SENTENCES = 5  # different sentences it stands in: copies of one text prove nothing
EPOCHS, STEP, PENALTY = 150, 0.3, 3e-5
FIRST_BIAS = -5.0
BACKGROUND = 0.25
CALIBRATE = 5
LEAST_CALIBRATION = 1_000  # sentences
SETTLING = 100  # epochs in which the background grows

WORD_GAPS = np.ones(256, dtype=bool)
WORD_GAPS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1),
           *range(ord("0"), ord("9") + 1), ord("'"), *range(0x80, 0x100)]] = False
SENTENCE_ENDS = np.zeros(256, dtype=bool)
SENTENCE_ENDS[[ord("."), ord("!"), ord("?"), ord("\n")]] = True

SCORES = "doc_id long, score double, sentences array<struct<start:int,end:int,score:double>>"


@dataclass
class Sentences:
    """Word features of a block: features[i] (words x kinds) of each word,
    the first word of each sentence, its document and byte range."""

    features: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def sentences(block: TextBlock) -> Sentences:
    data = block.data
    words = split_words(block, WORD_GAPS)
    n = len(words.start)
    lengths = words.end - words.start
    kinds = [hash_words(data, words.start, words.end, lower=True)]
    running = np.zeros(n, dtype=np.uint64)
    for j in range(max(BEGINNINGS)):
        there = lengths > j
        at = np.where(there, words.start + j, 0)
        if n:
            running += np.where(there, BYTE_VALUES[True][data[at]] * BYTE_POWERS[j], np.uint64(0))
        if j + 1 in BEGINNINGS:
            # Shorter words repeat their whole-word feature's bucket 0, which has no weight.
            kinds.append(np.where(there, mix64(running + np.uint64(j + 1)), np.uint64(0)))
    features = np.stack([(k % np.uint64(BUCKETS)).astype(np.int32) for k in kinds], axis=1)
    ends = np.concatenate(([0], np.cumsum(SENTENCE_ENDS[data])))
    key = ends[words.start] if n else np.zeros(0, np.int64)
    head = np.ones(n, dtype=bool)
    head[1:] = (key[1:] != key[:-1]) | (words.doc[1:] != words.doc[:-1])
    at = np.arange(n)
    within = at - np.maximum.accumulate(np.where(head, at, 0))
    first = np.flatnonzero(within % SENTENCE_WORDS == 0)
    last = np.append(first[1:], n) - 1
    return Sentences(features, first, words.doc[first], words.start[first],
                     words.end[last] if len(first) else first)


def share(z: np.ndarray, background: float) -> np.ndarray:
    """The logistic of z above the background, from 0 to 1."""
    s = 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
    return np.maximum(s - background, 0.0) / (1.0 - background)


@dataclass
class Model:
    weights: np.ndarray  # BUCKETS, float32; bucket 0 is always 0
    bias: float
    leak: float = 0.0  # -log(1 - leak) of a sentence

    def sentence_scores(self, s: Sentences) -> np.ndarray:
        """p of every sentence."""
        if not len(s.first):
            return np.zeros(0)
        weights = self.weights[s.features]
        z = np.add.reduceat(weights.sum(axis=1, dtype=float), s.first) + self.bias
        known = np.add.reduceat(np.count_nonzero(weights, axis=1), s.first) > 0
        return np.where(known, share(z, BACKGROUND), 0.0)

    def document_scores(self, s: Sentences, n_docs: int, p: np.ndarray | None = None) -> np.ndarray:
        """Noisy-or of each document's sentences. ``p``: their scores."""
        p = self.sentence_scores(s) if p is None else p
        none = np.bincount(s.doc, np.log1p(-np.minimum(p, 1 - 1e-9)) + self.leak, minlength=n_docs)
        return np.abs(np.expm1(np.minimum(none, 0.0)))


def _join_blocks(texts: list[str]) -> TextBlock:
    raw = [t.encode() for t in texts]
    return TextBlock(np.frombuffer(b"".join(raw), np.uint8),
                     np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))


def _featured(texts: list[str]) -> Iterator[tuple[int, Sentences]]:
    """(first text, its sentences) for blocks of texts, so that only one block's
    features are held at a time."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= BLOCK_BYTES):
            size += len(texts[stop])
            stop += 1
        yield at, sentences(_join_blocks(texts[at:stop]))
        at = stop


def train(texts: list[str], labels: list[int], class_rows: tuple[int, int] | None = None) -> Model:
    """Fit on whole texts with their labels. ``class_rows``: rows of class 0
    and 1 in the population the sample stands for. Equal texts with equal
    labels count once. Without both classes every score is 0."""
    rows = sorted(set(zip(texts, labels)))
    y = np.array([label for _, label in rows], dtype=float)
    if not len(y) or not 0 < y.sum() < len(y):
        return Model(np.zeros(BUCKETS, np.float32), -40.0)
    clean = [i for i, (_, label) in enumerate(rows) if not label]
    calibration = [rows[i][0] for i in clean[::CALIBRATE]] if len(clean) >= CALIBRATE else []
    if calibration:
        apart = set(clean[::CALIBRATE])
        rows = [row for i, row in enumerate(rows) if i not in apart]
        y = np.array([label for _, label in rows], dtype=float)
    texts, n_docs = [t for t, _ in rows], len(rows)
    texts_with, toxic_with = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at, s in _featured(texts):
        word_doc = np.repeat(s.doc, np.diff(np.append(s.first, len(s.features))))
        for kind in range(s.features.shape[1]):
            pairs = np.unique(s.features[:, kind].astype(np.int64) * n_docs + word_doc + at)
            texts_with += np.bincount(pairs // n_docs, minlength=BUCKETS)
            toxic_with += np.bincount(pairs // n_docs, y[pairs % n_docs], minlength=BUCKETS)
    rate = y.mean()
    z = (toxic_with - rate * texts_with) / np.sqrt(rate * (1 - rate) * np.maximum(texts_with, 1))
    used = (texts_with >= LEAST_TEXTS) & (z >= LEAST_Z)
    used[0] = False
    # Only used features are kept: a flat list with its sentence.
    columns, lines, docs, wordings, n_lines = [], [], [], [], 0
    for at, s in _featured(texts):
        if len(s.first):
            wordings.append(np.add.reduceat(mix64(s.features[:, 0].astype(np.uint64) + np.uint64(1)), s.first))
        sentence_of = np.repeat(np.arange(len(s.first)), np.diff(np.append(s.first, len(s.features))))
        keep = used[s.features]
        columns.append(s.features[keep])
        lines.append(np.broadcast_to(sentence_of[:, None], keep.shape)[keep] + n_lines)
        docs.append(s.doc + at)
        n_lines += len(s.first)
    column, line, doc = np.concatenate(columns).astype(np.int64), np.concatenate(lines), np.concatenate(docs)
    _, wording = np.unique(np.concatenate(wordings), return_inverse=True)
    accused = y[doc[line]] == 1
    pairs = np.unique(column[accused] * (n_lines + 1) + wording[line[accused]])
    often = np.bincount(pairs // (n_lines + 1), minlength=BUCKETS) >= LEAST_SENTENCES
    names, column = np.unique(column[often[column]], return_inverse=True), line[often[column]]
    (names, column), line = names, column
    counted = np.ones(n_docs)
    if class_rows is not None:
        counts = np.array([(y == 0).sum(), (y == 1).sum()])
        counted = (np.array(class_rows) / counts)[y.astype(int)]
        counted = counted / counted.mean()
    # Sentences without a used feature have p = 0 and no part in the gradient.
    evident = np.bincount(line, minlength=n_lines) > 0
    w, b = np.zeros(len(names)), FIRST_BIAS
    square, square_b = np.full(len(names), 1e-8), 1e-8
    for epoch in range(EPOCHS):
        background = BACKGROUND * min(1.0, epoch / SETTLING)
        z = np.bincount(line, w[column], minlength=n_lines) + b
        p = np.where(evident, share(z, background), 0.0)
        log_none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=n_docs)
        none = np.exp(log_none)
        blame = np.where(y == 1, none / np.maximum(1.0 - none, 1e-9), -1.0) * counted
        # log(1 - p) falls by s for each unit of z, where p > 0.
        up = np.where(p > 0, background + (1.0 - background) * p, 0.0) * blame[doc]
        g = np.bincount(column, up[line], minlength=len(names)) / n_docs
        square += g * g
        rate = STEP / np.sqrt(square)
        w = w + rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * PENALTY, 0.0)  # absolute-value penalty
        g_b = up.sum() / n_docs
        square_b += g_b * g_b
        b = min(b + STEP * g_b / np.sqrt(square_b), -2.0)
    weights = np.zeros(BUCKETS, np.float32)
    weights[names] = w
    model = Model(weights, float(b))
    if calibration:
        # One whole sentence is added to what was seen, for what was not.
        found = [model.sentence_scores(s) for _, s in _featured(calibration)]
        added, n = -sum(np.log1p(-np.minimum(p, 0.5)).sum() for p in found), sum(map(len, found))
        model.leak = float((added + np.log(2.0)) / max(n, 1)) if n >= LEAST_CALIBRATION else 0.0
    return model


def held_out(doc_id) -> Column:
    """Rows that training never sees."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def sample_and_train(docs: DataFrame, labels: DataFrame) -> Model:
    """Train from a bounded sample of labelled documents outside the held-out
    rows. Null labels and null texts are left out; a doc_id that is labelled
    more than once counts by its greatest label, and one that has several texts
    by the least of them, so repeats make no sample larger."""
    known = (labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    totals = {int(r["toxic"]): r["n"] for r in  # two rows
              known.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ids = None
    for label, most in ((0, SAMPLE_CLEAN), (1, SAMPLE_TOXIC)):
        one = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids = one if ids is None else ids.union(one)
    rows = (docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS))
            .join(F.broadcast(ids), "doc_id")  # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect())
    return train([r["text"] for r in rows], [int(r["toxic"]) for r in rows],
                 (totals.get(0, 0), totals.get(1, 0)))


def _scorer(model: Model, locate: float):
    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            for at, stop, block in blocks(batch):
                s = sentences(block)
                p = model.sentence_scores(s)
                scores = model.document_scores(s, len(block), p)
                found: list[list] = [[] for _ in range(len(block))]
                bad = np.flatnonzero(p >= locate)
                if len(bad):
                    chars = np.concatenate(([0], np.cumsum((block.data & 0xC0) != 0x80)))
                    for i in bad:
                        base = chars[block.offsets[s.doc[i]]]
                        found[s.doc[i]].append({"start": int(chars[s.start[i]] - base),
                                                "end": int(chars[s.end[i]] - base), "score": float(p[i])})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at), pa.array(scores), pa.array(found, kind)],
                    names=["doc_id", "score", "sentences"])

    return run


def score_toxicity(docs: DataFrame, model: Model, locate: float = 0.5) -> DataFrame:
    """doc_id, score and the sentences that offend on their own (code point
    ranges), for every row. Null and empty texts, and texts without a word,
    score 0. Other columns are ignored."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scorer(model, locate), SCORES)


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, by a model of the
    rows that are not held out.

    Null and empty texts score 0; rows with a null doc_id are scored, and not
    held out; repeated rows are scored each; other columns are ignored. Without
    labels of both classes every score is 0; an empty table gives no rows."""
    scored = score_toxicity(docs, sample_and_train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with their columns of any name, that the trained model does
    not reject. Rows with null or empty text stay; repeated rows stay or go
    together; an empty table stays empty."""
    model = sample_and_train(docs, labels)
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            keep = []
            for _, _, block in blocks(batch):
                keep.append(model.document_scores(sentences(block), len(block)) < 0.5)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
