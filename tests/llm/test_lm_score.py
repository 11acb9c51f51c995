"""LM scoring (op11) against a plain computation of the smoothed model."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import linkloom.llm.lm_score as L
from linkloom.llm.lm_score import score_digest, score_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"
BEGIN, END = object(), object()


class Plain:
    def __init__(self, rows, order):
        """rows: (text, whether it is learned from)."""
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        for text, learn in rows:
            seq = self.tokens(text)
            for k in range(1, order + 1) if learn else ():
                self.counts[k].update(seq[e - k + 1:e + 1] for e in range(len(seq)) if e >= k - 1 and (e or k == 1))
        words = {g: n for g, n in self.counts[1].items() if g != (BEGIN,)}
        self.n = sum(words.values())
        types = [len(words), *(len(c) for c in self.counts[2:])]
        self.v = types[0]
        self.lower = [max(b, 1) / max(a, 1) for a, b in zip(types, types[1:])]

    @staticmethod
    def tokens(text):
        return (BEGIN, *WORD.findall((text or "").translate(LOWER)), END)

    def p(self, context, word):
        k = len(context) + 1
        if k == 1:
            return (self.counts[1][word,] + 0.1) / (self.n + 0.1 * (self.v + 1))
        m = self.lower[k - 2]
        return ((self.counts[k][*context, word] + m * self.p(context[1:], word))
                / (self.counts[k - 1][context] + m))

    def expect(self, text):
        seq = self.tokens(text)
        score = sum(math.log10(self.p(seq[max(0, e - self.order + 1):e], seq[e])) for e in range(1, len(seq)))
        base = sum(math.log10(self.p((), w)) for w in seq[1:])
        return len(seq) - 1, sum(self.counts[1][w,] > 0 for w in seq[1:]), self.n, base, score


def check(got, want):
    assert tuple(got[:3]) == want[:3]
    for a, b in zip(got[3:], want[3:]):
        assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_table_against_plain_model(spark, monkeypatch, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if order != L.ORDER:
        docs = docs.limit(60)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = Plain([(t, zlib.crc32(str(i).encode()) % 10 != 0) for i, t in rows], order)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in score_texts(df, ~L.held_out(F.col("doc_id")), order, 1_000).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        check(got[i], model.expect(text))


def test_probabilities_of_a_context_add_up_to_one():
    model = Plain([("a b a c", True), ("a b", True), ("c", True)], 3)
    words = [*"abc", END, "unknown"]
    for context in ((), ("a",), ("a", "b"), (BEGIN, "c"), ("x", "y")):
        assert math.isclose(sum(model.p(context, w) for w in words), 1.0)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    rows = score_digest(spark.read.parquet(f"{SF}/documents.parquet")).where("held_out").collect()
    assert len(rows) > 10 and sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_odd_rows(spark):
    """Nulls, empty texts, repeated rows, null ids, clashing columns, no rows."""
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (4, "A b"), (None, "zz top"), (5, "Été b " * 3)]
    kind = "doc_id long, text string, words int, learn int, block int, ids int"
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in texts], kind)
    model = Plain([(t, i is not None and zlib.crc32(str(i).encode()) % 10 != 0) for i, t in texts], 2)
    got = score_digest(df).collect()
    assert len(got) == len(texts)
    want = Counter(repr((i, *model.expect(t)[:3])) for i, t in texts)
    assert Counter(repr((r.doc_id, r.n_tokens, r.n_known, r.train_tokens)) for r in got) == want
    for r in got:
        check(tuple(r)[2:], next(model.expect(t) for i, t in texts if i == r.doc_id))
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    assert score_digest(df.limit(0)).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for r in score_texts(df, F.lit(False)).collect():
        assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_a_very_long_text(spark):
    text = "to be or not " * 400_000
    df = spark.createDataFrame([(1, text), (2, "to be")], "doc_id long, text string")
    got = {r.doc_id: r for r in score_texts(df, F.lit(True)).collect()}
    model = Plain([(text, True), ("to be", True)], 2)
    check(tuple(got[2])[1:], model.expect("to be"))
    assert got[1].n_tokens == 1_600_001
