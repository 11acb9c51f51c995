"""Language ID by hierarchical discrimination.

First the language family is predicted (one-versus-rest linear support
vector machines over families), then one-versus-one machines tell the
languages of that family apart; a language's margins against its relatives
are added up. Families are learned: the languages' mean vectors are joined
pair by pair, the most alike first, while a pair of groups is more alike than
two languages are on average, and no family has more than ``FAMILY_MOST``
languages; so the number of machines grows with the languages, not with their
square. A table of families can be given instead.

Features are hashed byte 1-, 2- and 3-grams of the lower-cased letters
(everything else reads as a space) and whole words, as the square roots of
their frequencies, which gives unit vectors. The machines are fitted on a bounded
sample: about ``SAMPLE`` documents a language and ``SAMPLE_ROWS`` in all, but
``LEAST_OF_LANGUAGE`` of each language at the least, at most ``SAMPLE_CHARS``
characters each. However rare a language is, it is learned. Prediction reads
every whole text, with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .textblocks import TextBlock, blocks, hash_words, mix64, split_words

SAMPLE, SAMPLE_ROWS, LEAST_OF_LANGUAGE, SAMPLE_CHARS = 800, 16_000, 8, 20_000
FAMILY_MOST = 12
BUCKETS = 4096
BLOCK_DOCS = 256
ROUNDS, PENALTY = 150, 1e-4
UNKNOWN = "und"

LETTERS = np.full(256, 0x20, dtype=np.uint8)
for _c in range(256):
    if chr(_c).isascii() and chr(_c).isalpha() or _c >= 0x80:
        LETTERS[_c] = ord(chr(_c).lower()) if _c < 0x80 else _c
ASCII_LETTER = np.array([chr(c).isascii() and chr(c).isalpha() for c in range(256)])
GAPS = LETTERS == 0x20


def learn_families(means: np.ndarray, most: int = FAMILY_MOST) -> list[int]:
    """The family number of each language, from the languages' mean vectors."""
    n = len(means)
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    alike = unit @ unit.T  # of groups: the mean over their pairs of languages
    least = float(alike[np.triu_indices(n, 1)].mean()) if n > 1 else 0.0
    np.fill_diagonal(alike, -np.inf)
    group, size = np.arange(n), np.ones(n)
    while n > 1:
        a, b = sorted(np.unravel_index(int(alike.argmax()), alike.shape))
        if not alike[a, b] > least:
            break
        if size[a] + size[b] > most:
            alike[a, b] = alike[b, a] = -np.inf
            continue
        joined = (size[a] * alike[a] + size[b] * alike[b]) / (size[a] + size[b])
        joined[[a, b]] = -np.inf
        alike[a], alike[:, a], alike[b], alike[:, b] = joined, joined, -np.inf, -np.inf
        size[a] += size[b]
        group[group == b] = a
    _, numbers = np.unique(group, return_inverse=True)
    return numbers.tolist()


def vectors(block: TextBlock) -> np.ndarray:
    """Unit feature vector of each document (documents x BUCKETS)."""
    n_docs, off = len(block), block.offsets
    letters = LETTERS[block.data]
    doc = np.repeat(np.arange(n_docs), np.diff(off))
    counts = np.zeros(n_docs * BUCKETS)
    gram = np.zeros(len(letters), dtype=np.uint64)
    for n in range(3):
        m = len(letters) - n
        if m <= 0:
            break
        gram = gram[:m] * np.uint64(257) + letters[n:].astype(np.uint64) + np.uint64(1)
        same = doc[:m] == doc[n:]
        bucket = mix64(gram) % np.uint64(BUCKETS)
        counts += np.bincount(doc[:m][same] * BUCKETS + bucket[same].astype(np.int64), minlength=len(counts))
    words = split_words(block, GAPS)
    bucket = hash_words(block.data, words.start, words.end, lower=True) % np.uint64(BUCKETS)
    counts += np.bincount(words.doc * BUCKETS + bucket.astype(np.int64), minlength=len(counts))
    counts = counts.reshape(n_docs, BUCKETS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def fit_machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear support vector machine (squared hinge, accelerated gradient),
    classes weighted equally; the last entry is the bias, for which the last
    column of ``x`` is 1. ``y`` is -1 or 1."""
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, t = w.copy(), 1.0
    rate = 1.0 / (2.0 * 2.0 + PENALTY)  # rows have squared length 2
    for _ in range(ROUNDS):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead))
        grad = PENALTY * ahead - 2.0 * (x.T @ (share * y * slack))
        new = ahead - rate * grad
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + np.float32((before - 1) / t) * (new - w), new
    return w


@dataclass
class Model:
    families: list[str]
    members: dict[str, list[str]]
    family_weights: np.ndarray  # families x (BUCKETS + 1)
    pairs: dict[str, list[tuple[int, int]]]
    pair_weights: dict[str, np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and a score in 0..1 (logistic of the deciding margin)."""
        n = len(x)
        if not self.families:
            return [UNKNOWN] * n, np.zeros(n)
        margins = x @ self.family_weights[:, :-1].T + self.family_weights[:, -1]
        chosen = margins.argmax(axis=1)
        sure = margins.max(axis=1) if len(self.families) > 1 else np.full(n, 4.0)
        langs = [""] * n
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            members = self.members[name]
            if len(members) == 1:
                for i in rows:
                    langs[i] = members[0]
                continue
            w = self.pair_weights[name]
            duel = x[rows] @ w[:, :-1].T + w[:, -1]
            votes = np.zeros((len(rows), len(members)))
            for k, (a, b) in enumerate(self.pairs[name]):
                votes[:, a] += duel[:, k]
                votes[:, b] -= duel[:, k]
            for i, v in zip(rows, votes):
                langs[i] = members[int(v.argmax())]
                sure[i] = min(sure[i], v.max() / (len(members) - 1))
        return langs, 1.0 / (1.0 + np.exp(-2.0 * sure))


def _stacked(texts: list[str]) -> np.ndarray:
    """Feature vectors of texts with a last column of ones."""
    out = np.ones((len(texts), BUCKETS + 1), np.float32)
    for k in range(0, len(texts), BLOCK_DOCS):
        raw = [t.encode() for t in texts[k:k + BLOCK_DOCS]]
        off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        out[k:k + len(raw), :-1] = vectors(TextBlock(np.frombuffer(b"".join(raw), np.uint8), off))
    return out


def train(texts: list[str], langs: list[str], families_of: dict[str, str] | None = None) -> Model:
    """Fit both levels. ``families_of``: the family of each language by its
    code in place of learned families (languages that it lacks form one).
    Without texts every prediction is ``und``."""
    rows = sorted(set(zip(texts, langs)))
    if not rows:
        return Model([], {}, np.zeros((0, BUCKETS + 1)), {}, {})
    x = _stacked([t for t, _ in rows])
    names, number = np.unique(np.array([v for _, v in rows], dtype=object), return_inverse=True)
    lang = names[number]
    if families_of is None:
        means = np.stack([x[number == i, :-1].mean(axis=0) for i in range(len(names))])
        family = {name: f"family {k}" for name, k in zip(names, learn_families(means))}
    else:
        family = {name: families_of.get(name, "other") for name in names}
    home = np.array([family[v] for v in lang])
    members: dict[str, list[str]] = {}
    for name in names:
        members.setdefault(family[name], []).append(name)
    families = sorted(members)
    top = [fit_machine(x, np.where(home == f, 1.0, -1.0).astype(np.float32)) for f in families]
    pairs, weights = {}, {}
    for f in families:
        pairs[f] = list(combinations(range(len(members[f])), 2))
        fitted = []
        for a, b in pairs[f]:
            one = (lang == members[f][a]) | (lang == members[f][b])
            fitted.append(fit_machine(x[one], np.where(lang[one] == members[f][a], 1.0, -1.0)
                                      .astype(np.float32)))
        weights[f] = np.array(fitted).reshape(-1, BUCKETS + 1)
    return Model(families, members, np.array(top), pairs, weights)


def held_out(doc_id) -> Column:
    """Rows that training never sees."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def sample_and_train(docs: DataFrame, families_of: dict[str, str] | None = None) -> Model:
    """Train from about ``SAMPLE`` documents of each language outside the
    held-out rows (fewer where there are many languages), chosen by hash of the
    doc_id. Rows that repeat a doc_id in a language count once, by the least of
    their texts. A language that has no text of 1 to ``SAMPLE_CHARS``
    characters cannot be learned."""
    known = (docs.select("doc_id", "lang", "text").where("lang is not null and doc_id is not null")
             .where(~held_out(F.col("doc_id"))).where(F.length("text").between(1, SAMPLE_CHARS)))
    counts = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
    n_langs = counts.count()
    each = max(LEAST_OF_LANGUAGE, min(SAMPLE, SAMPLE_ROWS // max(n_langs, 1)))
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language sample")), 11) / float(1 << 53)
    # A rare language takes part whole: a draw by chance could miss it.
    whole = max(each, 4 * LEAST_OF_LANGUAGE)
    # One row a language, as many as the model has classes: no text is moved to meet its language.
    rows = (known.join(F.broadcast(counts), "lang").where((F.col("n") <= whole) | (place < F.lit(float(each)) / F.col("n")))
            .groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("text", "lang").collect())
    return train([r["text"] for r in rows], [r["lang"] for r in rows], families_of)


def has_letter(block: TextBlock) -> np.ndarray:
    """Whether each document has a letter of any script."""
    def some(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[block.offsets[1:]] > total[block.offsets[:-1]]

    found = some(ASCII_LETTER[block.data])
    for i in np.flatnonzero(~found & some(block.data >= 0x80)):
        found[i] = any(c.isalpha() for c in block.text_bytes(i).decode("utf-8", "replace"))
    return found


def _predictor(model: Model):
    def run(batches):
        for batch in batches:
            for at, stop, block in blocks(batch, most=BLOCK_DOCS):
                langs, scores = model.predict(vectors(block))
                letters = has_letter(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at),
                     pa.array([v if ok else UNKNOWN for v, ok in zip(langs, letters)], pa.string()),
                     pa.array(np.where(letters, scores, 0.0).astype(float))],
                    names=["doc_id", "lang_pred", "score"])

    return run


def predict_languages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row. Null texts and texts without
    a letter are ``und`` with score 0; other columns are ignored."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predictor(model), "doc_id long, lang_pred string, score double")


def language_digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, by a model of the
    rows that are not held out. Null texts and texts without a letter are
    ``und``; rows with a null doc_id are predicted, and not held out; repeated
    rows are predicted each; other columns are ignored; an empty table gives no
    rows."""
    found = predict_languages(docs, sample_and_train(docs))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        "lang_pred", "score")
