"""Source divergence (op13): against a plain computation, and odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import linkloom.llm.divergence as D
from linkloom.llm.divergence import sort_pointers, source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=3, ranks=200):
    docs, total, groups = Counter(), Counter(), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = Counter(TERM.findall((text or "").translate(LOWER)))
        groups[lang, source].update(found)
        docs.update((lang, t) for t in found)
        total.update({(lang, t): n for t, n in found.items()})
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for la, t in docs if la == lang and docs[la, t] >= min_docs)
        sources = [g[1] for g in groups if g[0] == lang]

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(groups[lang, s]) for s in sources}
        q = shares(Counter({t: total[lang, t] for t in kept}))
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if groups[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found[:most], 1)]
    return sorted(out)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    return sorted(tuple(r) for r in source_divergence(df, **options).collect())


def test_random_rows_against_brute_force(spark, monkeypatch):
    """Small slices, few pairs and sums at a time, long terms that share beginnings."""
    monkeypatch.setattr(D, "TERM_RANKS", 5)
    rng = random.Random(5)
    words = ["a", "B", "über", "Éa", "日本", "x" * 70, "x" * 70 + "y", "x" * 64, "abcdefgh", "abcdefghi", "zz-top",
             "don't", "w1w2", "٣"]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "", None]),
             " ".join(rng.choices(words, k=rng.randrange(12)))) for _ in range(80)]
    assert got(spark, rows, term_ranks=5) == brute(rows, ranks=5)


def test_odd_rows(spark):
    """Nulls, groups without terms, a language without kept terms, repeated
    rows, clashing and other columns, an empty table."""
    rows = [("en", "a", "one two"), ("en", "a", "one two"), ("en", "b", "one two three"), ("en", "c", None),
            ("en", None, ""), ("fr", "a", "seul"), ("fr", "b", None), (None, None, None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                               "lang string, source string, text string, term int, n int, docs int")
    assert sorted(tuple(r) for r in source_divergence(df).collect()) == brute(rows)


def test_a_long_term_and_a_long_text(spark):
    rows = [("en", "a", "q" * 3_000_000), ("en", "b", "q" * 3_000_000 + " " + "Word " * 300_000),
            ("en", "b", "word " + "q" * 3_000_000), ("en", "a", "word")]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_pointers_come_in_byte_order(seed):
    rng = random.Random(seed)
    terms = [bytes(rng.choices([97, 98, 0xC3], k=rng.choice([1, 2, 7, 8, 9, 16, 63, 64, 65, 80]))) for _ in range(400)]
    terms += [b"a" * n for n in (8, 16, 64, 72, 100, 100)]
    start = np.cumsum([0] + [len(t) + 1 for t in terms])[:-1]
    data = np.frombuffer(b" ".join(terms) + b" ", np.uint8)
    order, head = sort_pointers(data, start, start + [len(t) for t in terms])
    assert order.tolist() == sorted(range(len(terms)), key=lambda i: (terms[i], i))
    in_order = [terms[i] for i in order]
    assert head.tolist() == [True] + [a != b for a, b in zip(in_order, in_order[1:])]
