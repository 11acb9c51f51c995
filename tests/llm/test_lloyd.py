"""Dimension-sharded Lloyd (op12): against a plain computation, and odd rows."""

import hashlib
import math
import random

from linkloom.llm.lloyd import MOST, cluster_digest, cluster_vectors

ROW = "vec_id long, embedding array<double>, cluster int, n int"


def brute(rows, k, rounds, dims, scale=64):
    kept = [(i, [max(-MOST, min(MOST, math.floor(scale * max(-MOST, min(MOST, x))))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "z", v) for i, v in kept)
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), f in zip(kept, found) if f == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept] if centroids else []
    return sorted(out, key=repr), centroids


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], ROW).repartition(3)
    found, centroids = cluster_vectors(df, **options)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    want, final = brute(rows, options["k"], options["rounds"], options["dims"])
    assert got == want and centroids.tolist() == final
    return got


def test_random_vectors_in_uneven_blocks(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(5)]) for i in range(90)]
    check(spark, rows, k=4, rounds=3, dims=5, block_dims=2, chunk_rows=7)


def test_odd_rows(spark):
    """Nulls, other lengths, not finite, huge components, repeated ids and
    vectors, ties, null ids."""
    big = 1.7e308
    rows = [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (1, [3.0, 3.0]), (2, [0.5, 0.5]), (None, [9.0, 9.0]), (3, None),
            (4, [1.0]), (5, [1.0, None]), (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (8, [big, -big]),
            (9, [0.0, -0.0]), (10, [-1.0, 1.0]), (11, [1.0, -1.0]), (12, [])]
    got = check(spark, rows, k=4, rounds=2, dims=2, block_dims=1, chunk_rows=2)
    assert len(got) == 9
    check(spark, rows[:2], k=4, rounds=1, dims=2)
    check(spark, rows[4:8], k=4, rounds=1, dims=2)  # one vector, without an id
    check(spark, [], k=4, rounds=1, dims=2)


def test_digest_of_empty_table_and_few_vectors(spark):
    df = spark.createDataFrame([(1, [0.25] * 64), (2, [0.25] * 64)], "vec_id long, embedding array<float>")
    sha = hashlib.sha256(",".join(["16"] * 64).encode()).hexdigest()
    assert sorted(tuple(r) for r in cluster_digest(df).collect()) == [(1, 0, 0, 0, 0, sha), (2, 0, 0, 0, 0, sha)]
    assert cluster_digest(df.limit(0)).collect() == []
