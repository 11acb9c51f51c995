"""Toxicity (op5) and language identification (op8): held-out accuracy."""

import zlib

import numpy as np

import linkloom.llm.langid as L
import linkloom.llm.toxicity as T
from linkloom.llm.langid import language_digest, predict_languages
from linkloom.llm.toxicity import score_toxicity, toxicity_digest, without_toxic

SF = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity_digest(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = np.mean([r.predicted == truth[r.doc_id] for r in held])
    toxic = [r for r in held if truth[r.doc_id] == 1]
    clean = [r for r in held if truth[r.doc_id] == 0]
    assert right >= 0.96
    assert np.mean([r.predicted for r in toxic]) >= 0.75
    assert np.mean([r.predicted for r in clean]) <= 0.01


def toy(n=300):
    rng = np.random.default_rng(0)
    words = [f"word{i}" for i in range(200)]
    texts, labels = [], []
    for k in range(n):
        lines = [" ".join(rng.choice(words, 8)) + "." for _ in range(10)]
        if k % 3 == 0:
            lines[4] = "you horrible rotten thing " + lines[4]
        texts.append(" ".join(lines))
        labels.append(int(k % 3 == 0))
    return texts, labels


def test_offending_sentence_is_located(spark):
    texts, labels = toy()
    model = T.train(texts, labels)
    docs = spark.createDataFrame([(i, "é " + t) for i, t in enumerate(texts[:30])], "doc_id long, text string")
    for r in score_toxicity(docs, model).collect():
        assert (r.score >= 0.5) == bool(labels[r.doc_id])
        found = [("é " + texts[r.doc_id])[s.start:s.end] for s in r.sentences]
        assert all(f.startswith("you horrible rotten thing") for f in found)
        assert len(found) == labels[r.doc_id]


def test_noisy_or_equals_the_formula():
    texts, labels = toy(60)
    model = T.train(texts, labels)
    block = T._join_blocks(texts)
    s = T.sentences(block)
    scores = model.document_scores(s, len(block))
    weights, at = model.weights.astype(float), np.append(s.first, len(s.features))
    for i in range(len(texts)):
        none = 1.0
        for k in np.flatnonzero(s.doc == i):  # every sentence, from its words
            mine = weights[s.features[at[k]:at[k + 1]]]
            logistic = 1 / (1 + np.exp(-(mine.sum() + model.bias)))
            p = max(0.0, logistic - T.BACKGROUND) / (1 - T.BACKGROUND) if mine.any() else 0.0
            none *= (1 - p) * np.exp(model.leak)
        assert abs(scores[i] - max(0.0, 1 - none)) < 1e-6


def test_middling_sentences_add_up():
    """Ten sentences of 0.45 are a toxic text; one is none; ten thousand
    without evidence are none."""
    model = T.Model(np.zeros(T.BUCKETS, np.float32), -4.0, 1e-4)
    bucket = int(T.sentences(T._join_blocks(["ill"])).features[0, 0])
    s = 0.45 * (1 - T.BACKGROUND) + T.BACKGROUND
    model.weights[bucket] = np.log(s / (1 - s)) + 4.0
    texts = ["An ill day. " * 10, "An ill day. ", "A sunny day. " * 10_000, "A sunny day. " * 10_000 + "An ill day. " * 10]
    block = T._join_blocks(texts)
    scores = model.document_scores(T.sentences(block), len(block))
    assert abs(scores[0] - (1 - 0.55 ** 10)) < 2e-3 and abs(scores[1] - 0.45) < 1e-3
    assert scores[2] == 0 and scores[3] > 0.99


def test_copies_of_a_text_and_repeated_ids_prove_nothing(spark):
    """A word that stands in one sentence of many copies is no feature; rows
    that repeat a sampled doc_id make the sample no larger."""
    texts, labels = toy()
    copies = [f"Copied xylophone sentence here. {t}" if k == 0 else t for k, t in enumerate(texts)]
    copies += [f"Copied xylophone sentence here. Number {k}." for k in range(30)]
    model = T.train(copies, labels + [1] * 30)
    block = T._join_blocks(["xylophone"])
    assert model.document_scores(T.sentences(block), 1)[0] == 0
    docs = spark.createDataFrame([(i % 7, f"text number {i}") for i in range(700)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, toxic int")
    seen, real = [], T.train
    T.train = lambda texts, *rest: seen.append(texts) or real(texts, *rest)
    try:
        T.sample_and_train(docs, labels)
    finally:
        T.train = real
    assert 0 < len(seen[0]) <= 7


def test_long_clean_text_stays_clean(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = T.sample_and_train(docs, labels)
    clean = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").select("text").collect()]
    block = T._join_blocks(clean)
    scores = model.document_scores(T.sentences(block), len(block))
    long = " ".join(t for t, score in zip(clean, scores) if score < 0.5)
    assert len(T.sentences(T._join_blocks([long])).first) > 50_000
    toxic = [r.text for r in docs.join(labels.where("toxic = 1"), "doc_id").orderBy("doc_id").select("text").collect()]
    block = T._join_blocks(toxic)
    bad = toxic[int(model.document_scores(T.sentences(block), len(block)).argmax())]
    rows = spark.createDataFrame([(1, long), (2, long + "\n" + bad)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_toxicity(rows, model).collect()}
    assert got[1] < 0.5 <= got[2]


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 9), (1, 0, 9), (None, 1, 9), (2, None, 9), (7, 0, 9)],
                                   "doc_id long, toxic int, text int")
    rows = [(1, None, 1), (2, "", 1), (None, "x " * 50_000, 1), (2, "", 1), (3, "!!!", 1), (7, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = toxicity_digest(docs, labels).collect()
    assert len(got) == 6 and all(r.score < 1e-6 and r.predicted == 0 for r in got)
    left = without_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() == 6
    assert toxicity_digest(docs.limit(0), labels.limit(0)).count() == 0
    assert without_toxic(docs.limit(0), labels).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_digest(docs).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    model = L.train(["the cat and the dog"] * 3 + ["der hund und die katze"] * 3 + ["le chat et le chien"] * 3
                    + ["qqq zzz xxx"], ["en"] * 3 + ["de"] * 3 + ["fr"] * 3 + ["tlh"],
                    {"en": "germanic", "de": "germanic", "fr": "romance"})
    assert model.members == {"germanic": ["de", "en"], "romance": ["fr"], "other": ["tlh"]}
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 34 !?", "x"), (4, "日本", "x"), (None, "der hund", "x"),
            (5, "the dog " * 30_000, "x"), (5, "the dog " * 30_000, "x"), (6, "— … 12", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {(r.doc_id, r.lang_pred) for r in predict_languages(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (6, "und"), (None, "de"), (5, "en")} <= got
    assert dict(got)[4] != "und"
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in language_digest(unlabelled).collect()} == {"und"}
    assert language_digest(unlabelled.limit(0)).count() == 0


def test_families_are_learned_from_the_languages():
    """Against a plain average-linkage clustering, with and without the limit."""
    def plain(means, most):
        unit = means / np.linalg.norm(means, axis=1, keepdims=True)
        groups = [[i] for i in range(len(means))]
        sim = lambda g, h: np.mean([unit[i] @ unit[j] for i in g for j in h])
        least = np.mean([unit[i] @ unit[j] for i in range(len(means)) for j in range(i)])
        while True:
            pairs = [(sim(g, h), -i, -j) for i, g in enumerate(groups) for j, h in enumerate(groups) if i < j
                     and len(g) + len(h) <= most]
            if not pairs or max(pairs)[0] <= least:
                return {frozenset(g) for g in groups}
            _, i, j = max(pairs)
            groups[-i] += groups.pop(-j)

    rng = np.random.default_rng(8)
    for most in (3, 12):
        means = np.abs(rng.normal(size=(14, 6)))
        numbers = L.learn_families(means, most)
        got = {frozenset(i for i, n in enumerate(numbers) if n == k) for k in set(numbers)}
        assert got == plain(means, most) and max(map(len, got)) <= most
    assert L.learn_families(np.ones((1, 3))) == [0]


def test_every_language_can_be_predicted(spark):
    """Sixty languages, some of a few documents, beside one of many; a doc_id
    that comes a thousand times is one row of the sample."""
    rng = np.random.default_rng(2)
    words = {f"l{k}": ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(12)] for k in range(60)}
    rows = [(1000 * k + i, " ".join(rng.choice(w, 12)), lang) for k, (lang, w) in enumerate(words.items())
            for i in range(400 if k == 0 else 8)]
    rows += [(7, f"same id {i}", "l1") for i in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, real = [], L.train
    L.train = lambda texts, *rest: seen.append(texts) or real(texts, *rest)
    try:
        got = language_digest(docs).collect()
    finally:
        L.train = real
    assert len(seen[0]) < 400 + 60 * 8
    truth = {d: lang for d, _, lang in rows if d != 7}
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth]
    assert np.mean(right) > 0.97 and {r.lang_pred for r in got} == set(words)


def test_machines_learn_one_against_one():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 20)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.hstack([x, np.ones((200, 1), np.float32)])
    y = np.where(x[:, 3] > x[:, 5], 1.0, -1.0).astype(np.float32)
    w = L.fit_machine(x, y)
    assert (np.sign(x @ w) == y).mean() > 0.95
