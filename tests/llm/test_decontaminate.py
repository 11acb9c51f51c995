"""Pigeonhole edit matching (op1) against a plain edit-distance search."""

import random

from hypothesis import given, settings, strategies as st

import linkloom.llm.decontaminate as D
from linkloom.llm.decontaminate import Matcher, Pattern, find_leaks, normalise, pieces, places, without_leaks

SF = "/root/testdata/sf0.01"


def least_distance(item, text):
    """Least edits from ``item`` to any substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@given(st.text("abc", min_size=1, max_size=20), st.text("abc", max_size=40))
@settings(max_examples=200, deadline=None)
def test_myers(item, text):
    assert Pattern(item).best_end(text)[0] == least_distance(item, text)


@given(st.text("ab", min_size=4, max_size=24), st.text("ab", max_size=60), st.sampled_from([0.1, 0.2, 0.3]))
@settings(max_examples=200, deadline=None)
def test_matcher_finds_exactly_the_leaks(item, text, rate):
    found = Matcher([(7, item)], rate, 1, 0).find(text)
    spans = sorted((f[2], f[3]) for f in found)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    best = least_distance(item, text)
    if best > int(rate * len(item)):
        assert found == []
    else:
        assert min(f[1] for f in found) == best
        for _, distance, start, end in found:
            assert least_distance(item, text[start:end]) == distance


@given(st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_places(text):
    got, place = normalise(text), places(text)
    assert len(place) == len(got) + 1
    for c, p in zip(got, place):
        assert text[p].isspace() if c == " " else D.fold(text)[p] == c


def test_pieces_cover_the_item():
    for n in range(1, 60):
        for k in range(n):
            cut = pieces("x" * n, k)
            assert len(cut) == k + 1 and all(p for _, p in cut) and sum(len(p) for _, p in cut) == n


def damaged(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyzq")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyzq"))
    return "".join(chars)


def test_planted_leaks(spark):
    rng = random.Random(11)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = {r.item_id: r.text for r in bench.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    verbatim = {(d, i) for d, t in texts.items() for i, x in items.items() if normalise(x) in normalise(t)}
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()}
    assert verbatim and got == verbatim
    clean = sorted(set(texts) - {d for d, _ in got})[:40]
    planted = []
    for k, doc_id in enumerate(clean):
        item_id = sorted(items)[k % len(items)]
        item = items[item_id]
        piece = damaged(rng, item, int(0.08 * len(normalise(item))) - 1).replace(" ", " \n ")
        piece = "".join(c.upper() if c.isascii() else c for c in piece)
        planted.append((doc_id, texts[doc_id][:500] + " " + piece + " " + texts[doc_id][500:900], item_id))
    frame = spark.createDataFrame([p[:2] for p in planted], "doc_id long, text string")
    rows = find_leaks(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, i) for d, _, i in planted}
    by_doc = {d: t for d, t, _ in planted}
    for r in rows:
        span = normalise(by_doc[r.doc_id][r.start:r.end])
        assert least_distance(normalise(items[r.item_id]), span) == r.distance
    assert without_leaks(frame, bench).count() == 0


def test_blocks_and_odd_rows(spark, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    bench = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0), (4, "short", 0),
                                   (None, item[::-1], 0)], "item_id long, text string, doc_id long")
    rows = [(1, f"x {item.upper()} y", 5), (1, f"x {item.upper()} y", 5), (2, None, 5), (3, "", 5),
            (None, f"é\t{item[:20]}\n{item[20:]}", 5), (5, "short " * 30_000, 5), (6, item[::-1], 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id long")
    want = sorted([(1, 1)] * 4 + [(None, 1)] * 2 + [(5, 4)] * 30_000 + [(6, None)], key=str)
    for size in (D.BLOCK_CHARS, 50):  # one block, then several
        monkeypatch.setattr(D, "BLOCK_CHARS", size)
        got = find_leaks(docs, bench)
        assert sorted(((r.doc_id, r.item_id) for r in got.collect()), key=str) == want
        left = without_leaks(docs, bench)
        assert left.columns == docs.columns
        assert sorted((r.doc_id for r in left.collect()), key=str) == [2, 3, 5]
    spans = {(r.start, r.end) for r in find_leaks(docs, bench).where("doc_id = 1").collect()}
    assert spans == {(2, 2 + len(item))}
    assert find_leaks(docs, bench.limit(0)).count() == 0
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert without_leaks(docs, bench.limit(0)).count() == 7


def brute_short(item, text):
    """Whole-word occurrences from left to right."""
    out, at = [], text.find(item)
    while at >= 0:
        end = at + len(item)
        before, after = text[:at][-1:], text[end:][:1]
        if not (before.isalnum() and item[0].isalnum() or after.isalnum() and item[-1].isalnum()):
            out.append((0, at, end))
        at = text.find(item, end)
    return out


def test_items_of_any_length_and_every_match():
    """Items of 5 to 60 characters, copied side by side and apart, exact and
    with edits up to the budget: each copy is found, nothing else is."""
    rng = random.Random(23)
    words = ["river", "stone", "copper", "lantern", "a", "of", "meadow", "quiet", "silver", "harbour"]
    for size in range(5, 61):
        item = normalise(" ".join(rng.choices(words, k=20))[:size].strip()).ljust(size, "k")
        budget = int(0.08 * len(item)) if len(item) >= D.SHORT_CHARS else 0
        near = item
        while budget and (near == item or normalise(near) != near):  # an edit may leave two spaces side by side
            near = damaged(rng, item, budget)
        copies = [item, item, near, item]
        text = normalise("zzz " + " ".join(copies) + " " + "qqqq " * 30 + item + " x" + item + "x " + item)
        found = Matcher([(1, item)], 0.08).find(text)
        if budget:
            assert len(found) == 7
            for _, distance, start, end in found:
                assert least_distance(item, text[start:end]) == distance <= budget
        else:
            assert sorted(f[1:] for f in found) == sorted(brute_short(item, text)) and len(found) == 6


def test_short_items_are_reported_but_only_passages_make_documents_go(spark):
    bench = spark.createDataFrame([(1, "What is the capital city of France?"), (2, "Paris")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Q: what is the  capital city of france? A: Paris."), (2, "Paris, Parisian life"),
                                  (3, "comparisons")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end) for r in find_leaks(docs, bench).collect())
    assert got == [(1, 1, 3, 39), (1, 2, 43, 48), (2, 2, 0, 5)]
    assert sorted(r.doc_id for r in without_leaks(docs, bench).collect()) == [2, 3]
    assert sorted(r.doc_id for r in without_leaks(docs, bench, least_chars=1).collect()) == [3]


def test_many_copies_with_edits_side_by_side():
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    copy = item.replace("fox", "fix").replace("bank", "bunk")
    found = Matcher([(1, item)], 0.08).find(" ".join([copy] * 3_000))
    assert len(found) == 3_000 and {f[1] for f in found} == {2}
