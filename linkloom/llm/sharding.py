"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` equal cells. A document's cell comes from the
hash of its doc_id. Every shard owns ``vnodes`` points on the ring; a key
belongs to the next point clockwise and, while that point's shard is full,
continues clockwise. All keys walk at the same pace, one point a step, and a
shard that cannot take all who arrive takes them in ring order.

Which key goes where therefore follows from the number of keys per cell and
a key's rank within its cell: the counts (at most ``CELLS`` numbers, whatever
the input) are walked once on the driver, and the outcome is a table of at
most CELLS + points + shards rows (cell, rank range, shard, first slot)
that is joined back. Documents themselves are only counted, ranked within
their cell and joined, with DataFrame operations alone.

With ``load_factor=None`` the capacities add up to the number of rows, floor
or ceiling of the mean, so shard sizes are at most one row apart (law
``rows``). A factor above 1 leaves slack: ceil(factor * mean) per shard, with
less movement when shards come or go.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import join_path, new_work_dir

CELL_BITS = 14
CELLS = 1 << CELL_BITS
VNODES = 64
SHARDS = 24


def ring_points(n_shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. A shard's points do not
    depend on the other shards."""
    points = []
    for shard in range(n_shards):
        for v in range(vnodes):
            digest = hashlib.md5(f"shard {shard} point {v}".encode()).digest()
            position = int.from_bytes(digest[:8], "big")
            points.append((position >> (64 - CELL_BITS), position, shard))
    return [(cell, shard) for cell, _, shard in sorted(points)]


def capacities(n_rows: int, n_shards: int, load_factor: float | None) -> list[int]:
    if load_factor is None:
        low, extra = divmod(n_rows, n_shards)
        return [low + (shard < extra) for shard in range(n_shards)]
    if load_factor < 1:
        raise ValueError("the load factor is at least 1")
    return [-int(-load_factor * n_rows // n_shards)] * n_shards


def walk_ring(counts: dict[int, int], n_shards: int, vnodes: int = VNODES,
              load_factor: float | None = None) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, first slot) for ``counts`` keys per cell."""
    points = ring_points(n_shards, vnodes)
    room = capacities(sum(counts.values()), n_shards, load_factor)
    # Cells of the arc that ends at each point; cells past the last point wrap around.
    arcs: list[list[int]] = [[] for _ in points]
    at = 0
    for cell in sorted(counts):
        while at < len(points) and points[at][0] < cell:
            at += 1
        arcs[at % len(points)].append(cell)
    waiting = {a: sum(counts[c] for c in cells) for a, cells in enumerate(arcs) if cells}
    taken: dict[int, list[tuple[int, int]]] = {a: [] for a in waiting}
    for step in range(len(points)):
        for a in list(waiting):
            shard = points[(a + step) % len(points)][1]
            n = min(waiting[a], room[shard])
            if n:
                taken[a].append((shard, n))
                room[shard] -= n
                waiting[a] -= n
                if not waiting[a]:
                    del waiting[a]
        if not waiting:
            break
    rows, next_slot = [], [0] * n_shards
    for a, parts in taken.items():
        cells = iter(arcs[a])
        cell, used = next(cells), 0
        for shard, n in parts:
            while n:
                if used == counts[cell]:
                    cell, used = next(cells), 0
                here = min(n, counts[cell] - used)
                rows.append((cell, used, used + here, shard, next_slot[shard]))
                next_slot[shard] += here
                used += here
                n -= here
    return rows


def _as_table(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A bounded list as a DataFrame, through a JSON literal."""
    kind = "array<struct<" + ",".join(f"{n}:bigint" for n in names) + ">>"
    text = json.dumps([dict(zip(names, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def place_documents(docs: DataFrame, n_shards: int = SHARDS, vnodes: int = VNODES,
                    load_factor: float | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    Size is UTF-8 bytes plus 8, null text counts as empty. Repeated rows are
    separate keys that fill neighbouring ranks. A null doc_id takes its cell
    from the text's checksum. An empty table gives no rows; other columns
    are ignored."""
    spark = docs.sparkSession
    stored = join_path(new_work_dir(spark, "ring"), "keys")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    position = F.when(F.col("doc_id").isNull(), F.xxhash64(crc)).otherwise(F.xxhash64("doc_id"))
    (docs.select("doc_id",
                 (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
                 crc.cast("long").alias("text_crc32"), position.alias("position"))
     .withColumn("cell", F.shiftrightunsigned("position", 64 - CELL_BITS))
     .write.parquet(stored))
    keys = spark.read.parquet(stored)
    counts = {int(r["cell"]): int(r["n"]) for r in  # at most CELLS rows
              keys.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    names = ("cell", "low", "high", "shard", "first_slot")
    plan = _as_table(spark, walk_ring(counts, n_shards, vnodes, load_factor), names)
    order = Window.partitionBy("cell").orderBy("position", "doc_id", "text_crc32", "size")
    ranked = keys.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    k, p = ranked.alias("k"), F.broadcast(plan).alias("p")  # at most CELLS + points + shards rows
    return (k.join(p, (F.col("k.cell") == F.col("p.cell")) & (F.col("rank") >= F.col("low"))
                   & (F.col("rank") < F.col("high")))
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("first_slot") + F.col("rank") - F.col("low")).alias("slot")))


def shard_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: exact capacities, so the law is ``rows``."""
    return place_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
