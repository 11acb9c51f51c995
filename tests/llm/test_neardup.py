"""Near-duplicates (op9) against brute force."""

import random
import re

import numpy as np
import pytest

import linkloom.llm.neardup as N
from linkloom.llm.neardup import components, estimate, near_duplicates, sketch, without_near_duplicates
from linkloom.llm.textblocks import mix64

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """doc_id -> (n_shingles, component) over every pair."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {d: (len(sets[d]), find(d)) for d in ids}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute(rows)
    return got


def test_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


@pytest.mark.parametrize("few", [0, 200])
def test_groups_chains_and_shared_passages(spark, monkeypatch, few):
    """Stars around a base, chains, and documents that share only a passage;
    with ``few`` = 0 every open bucket takes the prefix filter."""
    monkeypatch.setattr(N, "PAIRS_OF_BUCKET", few)
    monkeypatch.setattr(N, "FREQUENT", 3)
    rng = random.Random(3)

    def text(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    rows = []
    base = text(200)
    for _ in range(25):  # about 0.86 similar to the base, less to each other
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = "x" + str(rng.randrange(10**6))
        rows.append(" ".join(copy))
    rows.append(" ".join(base))
    chain = text(150)
    for i in range(8):
        chain = chain[:150 - 12] + text(12) if i % 2 else text(10) + chain[10:]
        rows.append(" ".join(chain))
    passage = text(90)
    for _ in range(30):  # similarity about 0.6: no link
        rows.append(" ".join(passage + text(30)))
    rows += [" ".join(text(n)) for n in (1, 4, 5, 6, 300)] + ["a b", "A  b", "a b c", ""]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        n, common = int(rng.integers(200, 800)), rng.uniform(0.3, 0.95)
        shared = rng.integers(0, 2**63, int(n * common)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**63, n - len(shared)).astype(np.uint64)]))
                for _ in range(2))
        ra, rb = sketch([mix64(a), mix64(b)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = estimate(np.array([float(len(a))]), np.array([float(len(b))]),
                       np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]))[0]
        errors.append(got - true)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_registers_merge():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2**63, 300).astype(np.uint64) for _ in range(2))
    ra, rb, both = sketch([a, b, np.concatenate([a, b])])
    assert (np.maximum(ra, rb) == both).all()


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(links, N._Stored(spark)).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90}
    assert components(links.limit(0), N._Stored(spark)).count() == 0


@pytest.mark.parametrize("hubs", [0, 4, 1_000])
def test_components_with_hubs(spark, monkeypatch, hubs):
    """Stars whose hub is the largest, a middle or the smallest node, joined by
    chance: the same components whether no node, some or all count as hubs."""
    monkeypatch.setattr(N, "HUBS", hubs)
    rng = random.Random(8)
    edges = [(999, i) for i in range(300, 420)] + [(250, i) for i in range(200, 300) if i != 250]
    edges += [(-5, i) for i in range(0, 60)] + [(i, i + 1) for i in range(600, 620)]
    edges += [(rng.randrange(700, 760), rng.randrange(700, 760)) for _ in range(40)]
    edges += [(310, 205), (610, 700)] + edges[:10]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(links, N._Stored(spark)).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, 1), (2, "", 2), (4, long, 3), (3, long, 4), (3, long, 4), (None, long, 5),
            (None, None, 5), (5, "a b c d e f g", 6), (5, "a b c d e f g", 7), (6, " \n", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (4, 29_996, 3, False), (3, 29_996, 3, True),
                          (3, 29_996, 3, True), (None, 29_996, None, True), (None, 0, None, True),
                          (5, 3, 5, True), (5, 3, 5, True), (6, 0, 6, True)], key=str)
    left = without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 2, 3, 3, None, None, 5, 5, 6], key=str)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_a_hot_shingle_makes_no_pairs(spark, monkeypatch):
    """Documents of 25 common and 5 own words are no links (similarity 0.68).
    They all have the same two shingles among their rarest, and fail the length
    test as one group: no pair of rows is made. With linked pairs among them
    only those are found."""
    common = [f"common{i}" for i in range(25)]

    def rows(n):
        return [(i, " ".join(common + [f"own{i}x{k}" for k in range(5)])) for i in range(n)]

    made, real = [], N._links

    def counted(pairs, *rest):
        made.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(N, "_links", counted)
    docs = rows(600) + [(1_000 + i, " ".join(common + [f"own{i}x{k}" for k in range(4)] + ["other"])) for i in range(3)]
    check(spark, docs)
    assert made[1] <= 600  # not 600 * 599 / 2


def test_groups_that_can_be_linked_are_spread_out(spark):
    """The pairs of rows by groups are the pairs by rows."""
    rng = random.Random(12)
    rows = [(i, n, rng.randrange(6), rng.randrange(4), rng.randrange(max(1, n - 6), n + 1))
            for i in range(120) for n in [rng.choice((8, 9, 12, 13))]]
    df = spark.createDataFrame(rows, "rep long, n long, component long, shingle long, left long")
    want = {(min(a[0], b[0]), max(a[0], b[0])) for a in rows for b in rows if a[0] < b[0] and a[2] != b[2] and a[3] == b[3]
            and 100 * min(a[1], b[1]) >= 75 * max(a[1], b[1]) and 175 * min(a[4], b[4]) >= 75 * (a[1] + b[1])}
    got = [(r.a, r.b) for r in N._of_groups(df).collect()]
    assert want and sorted(got) == sorted(want)
