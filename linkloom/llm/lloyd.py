"""Centroid clustering: dimension-sharded Lloyd.

Vectors are dealt out by columns: a block holds ``BLOCK_DIMS`` components of
``CHUNK_ROWS`` vectors. A column-block task has only its slice of the
centroids and computes exact partial distances of its components; reducing by
chunk adds up the partial distances of its blocks and takes the nearest
centroid. The assignment goes back to the blocks, where each shard adds up
its components by cluster and so updates its own slice of the centroids.

Components are integers, floor(scale * x), so all sums are exact and nothing
depends on how the rows are dealt out. A chunk is a fixed number of rows
whatever their values are: a vector that a third of the table repeats makes
no task larger. The driver sees k centroids and their sums, never vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import join_path
from .shipping import ship
from .store import Store

K, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
SEED = "1"
BLOCK_DIMS = 16
CHUNK_ROWS = 1024
# Components beyond this (vectors with |x| of two million) are set to it, so that a squared
# distance over up to 64 components stays a 64-bit integer.
MOST = 1 << 27

BLOCKS = "chunk long, block int, n int, ids array<long>, slice binary"
PARTIAL = "chunk long, n int, partial binary"
NEAREST = "chunk long, clusters binary, distances binary"
SUMS = "cluster int, dim int, total long, n long"


def whole_components(embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer components of the vectors that are kept."""
    x = F.col("embedding")
    whole = F.transform(x, lambda v: F.least(F.greatest(F.floor(v.cast("double") * scale).cast("long"),
                                                        F.lit(-MOST)), F.lit(MOST)).cast("int"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where((F.size(x) == dims) & finite).select("vec_id", whole.alias("x")))


def _slicer(dims: int, block_dims: int, chunk_rows: int):
    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, chunk_rows):
                part = batch.slice(at, chunk_rows)
                n = part.num_rows
                x = part.column(1).flatten().to_numpy().reshape(n, dims).astype("<i4")
                lows = range(0, dims, block_dims)
                ids = part.column(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(lows), pa.int64()), pa.array(range(len(lows)), pa.int32()),
                     pa.array([n] * len(lows), pa.int32()),
                     pa.array([ids.to_pylist(), *[None] * (len(lows) - 1)], pa.list_(pa.int64())),
                     pa.array([x[:, a:a + block_dims].tobytes() for a in lows], pa.binary())],
                    names=["chunk", "block", "n", "ids", "slice"])
                chunk += 1

    return run


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def _partial(slices: list[np.ndarray]):
    """Partial squared distances of each block to its slice of the centroids."""

    def run(batches):
        for batch in batches:
            chunk, block, n, data = _columns(batch, "chunk", "block", "n", "slice")
            out = []
            for b, rows, raw in zip(block, n, data):
                x = np.frombuffer(raw, "<i4").reshape(rows, -1).astype(np.int64)
                out.append(np.stack([((x - c) ** 2).sum(axis=1) for c in slices[b]], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk, pa.int64()), pa.array(n, pa.int32()), pa.array(out, pa.binary())],
                names=["chunk", "n", "partial"])

    return run


def _nearest(table: pa.Table) -> pa.Table:
    """Adds up the blocks of one chunk; ties go to the smaller number."""
    total = sum(np.frombuffer(raw, np.int64) for raw in table.column("partial").to_pylist())
    total = total.reshape(table.column("n")[0].as_py(), -1)
    cluster = total.argmin(axis=1)
    distance = np.take_along_axis(total, cluster[:, None], axis=1)[:, 0]
    return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()], pa.int64()),
                     "clusters": pa.array([cluster.astype("<i4").tobytes()], pa.binary()),
                     "distances": pa.array([distance.astype("<i8").tobytes()], pa.binary())})


def _summed(k: int, dims: int, block_dims: int):
    """Component sums by cluster of the blocks a task holds."""

    def run(batches):
        sums = np.zeros((k, dims), np.int64)
        counts = np.zeros((k, dims), np.int64)
        for batch in batches:
            for b, raw, labels in zip(*_columns(batch, "block", "slice", "clusters")):
                cluster = np.frombuffer(labels, "<i4")
                x = np.frombuffer(raw, "<i4").reshape(len(cluster), -1).astype(np.int64)
                mine = slice(b * block_dims, b * block_dims + x.shape[1])
                np.add.at(sums[:, mine], cluster, x)
                counts[:, mine] += np.bincount(cluster, minlength=k)[:, None]
        cluster, dim = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(dim, pa.int32()), pa.array(sums[cluster, dim]),
             pa.array(counts[cluster, dim])], names=["cluster", "dim", "total", "n"])

    return run


def _rows(batches):
    for batch in batches:
        for ids, clusters, distances in zip(*_columns(batch, "ids", "clusters", "distances")):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.frombuffer(clusters, "<i4")),
                 pa.array(np.frombuffer(distances, "<i8"))], names=["vec_id", "cluster", "distance"])


class Lloyd:
    """The blocks of a table of vectors, and the steps over them."""

    def __init__(self, embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE,
                 block_dims: int = BLOCK_DIMS, chunk_rows: int = CHUNK_ROWS):
        spark = embeddings.sparkSession
        ship(spark)
        self.dims, self.block_dims = dims, block_dims
        self.store = Store(spark, "lloyd")
        self.whole = whole_components(embeddings, dims, scale)
        path = join_path(self.store.root, "blocks")
        sliced = self.whole.mapInArrow(_slicer(dims, block_dims, chunk_rows), BLOCKS)
        sliced.write.partitionBy("block").parquet(path)
        self.blocks = spark.read.schema(sliced.schema).parquet(path)

    def first_centroids(self, k: int, seed: str = SEED) -> np.ndarray:
        """The k vectors with the smallest hash of their id (k rows)."""
        place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
        rows = (self.whole.select(place.alias("place"), "x")
                .orderBy(F.asc_nulls_last("place"), "x").limit(k).collect())
        return np.array([r["x"] for r in rows], np.int64).reshape(-1, self.dims)

    def assign(self, centroids: np.ndarray) -> DataFrame:
        """chunk, clusters, distances."""
        slices = [centroids[:, a:a + self.block_dims] for a in range(0, self.dims, self.block_dims)]
        return (self.blocks.select("chunk", "block", "n", "slice").mapInArrow(_partial(slices), PARTIAL)
                .groupBy("chunk").applyInArrow(_nearest, NEAREST))

    def update(self, nearest: DataFrame, centroids: np.ndarray) -> np.ndarray:
        """The floor of the mean of every cluster; empty ones stay."""
        sums = (self.blocks.select("chunk", "block", "slice").join(nearest.select("chunk", "clusters"), "chunk")
                .mapInArrow(_summed(len(centroids), self.dims, self.block_dims), SUMS)
                .groupBy("cluster", "dim")
                .agg(F.sum(F.col("total").cast("decimal(38, 0)")).alias("total"), F.sum("n").alias("n")))
        new = centroids.copy()
        for r in sums.collect():  # k x dims numbers
            new[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
        return new

    def rows(self, nearest: DataFrame) -> DataFrame:
        """vec_id, cluster, distance of every vector."""
        ids = self.blocks.where("block = 0").select("chunk", "ids")
        return ids.join(nearest, "chunk").mapInArrow(_rows, "vec_id long, cluster int, distance long")


def cluster_vectors(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS,
                    scale: int = SCALE, seed: str = SEED, block_dims: int = BLOCK_DIMS,
                    chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and squared distance of every kept vector, and the
    final centroids.

    Kept are vectors of ``dims`` components, none null or non-finite; others,
    and null vectors, are left out. Every row is a vector, also one that
    repeats a vec_id or a vector; rows that repeat a vec_id among the first
    centroids start one each, in the order of their components. Vectors with a
    null vec_id come last in the choice of first centroids. With fewer than k
    vectors there are fewer centroids; an empty table gives no rows.
    Components beyond ``MOST`` count as that. Other columns are ignored."""
    lloyd = Lloyd(embeddings, dims, scale, block_dims, chunk_rows)
    centroids = lloyd.first_centroids(k, seed)
    if not len(centroids):
        spark = embeddings.sparkSession
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = lloyd.update(lloyd.assign(centroids), centroids)
    return lloyd.store.keep(lloyd.rows(lloyd.assign(centroids)), "assigned"), centroids


def cluster_digest(embeddings: DataFrame) -> DataFrame:
    """The rows of ``cluster_vectors`` with the inertias and each row's
    centroid by checksum. An inertia that no 64-bit integer holds is null."""
    spark = embeddings.sparkSession
    rows, centroids = cluster_vectors(embeddings)
    sums = {r["cluster"]: int(r["s"]) for r in  # at most k rows
            rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("s")).collect()}

    def long(n: int) -> int | None:
        return n if n < 1 << 63 else None

    about = [(c, long(s), long(sum(sums.values())),
              hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, s in sums.items()]
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return (rows.join(F.broadcast(spark.createDataFrame(about, kind)), "cluster")  # at most k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _assign_sql(n: int) -> str:
    return f"""
a{n} AS MATERIALIZED (
  SELECT rid, vec_id, x, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT v.rid, v.vec_id, v.x, c.c,
           list_sum(list_transform(range(1, {DIMS} + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS d
    FROM v CROSS JOIN c{n} c) GROUP BY ALL)"""


def _update_sql(n: int) -> str:
    return f"""
m{n} AS (
  SELECT c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
    SELECT best.c AS c, unnest(x) AS x, unnest(range(1, {DIMS} + 1)) AS i FROM a{n - 1}) GROUP BY ALL),
u{n} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS x FROM m{n} GROUP BY c),
c{n} AS MATERIALIZED (SELECT c{n - 1}.c, coalesce(u{n}.x, c{n - 1}.x) AS x FROM c{n - 1} LEFT JOIN u{n} USING (c))"""


CLUSTERS_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda y: greatest(least(floor(y::DOUBLE * {SCALE}), {MOST}), -{MOST})::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {DIMS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, x) - 1 AS c, x FROM v
  ORDER BY c LIMIT {K}),
{_assign_sql(0)},
{','.join(_update_sql(n) + ',' + _assign_sql(n) for n in range(1, ROUNDS + 1))}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c ON c.c = best.c"""
