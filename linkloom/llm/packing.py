"""Packing: shortest-pack-first over the length histogram.

1. Encode every document, append the end id and cut it into pieces of at
   most the capacity (full pieces, then the rest).
2. Count pieces by length: at most ``capacity`` numbers, whatever the input.
3. On that histogram place lengths longest first; each length goes to the
   open packs with the most room (the shortest packs), a whole count at a
   time. The result is a list of patterns with counts.
4. Each slot of a pattern owns a range of ranks of its length. Pieces get a
   rank within their length and find pattern, sequence and offset by it.

The histogram and the patterns are bounded by the capacity alone: a step
either uses up a length or moves a whole group of packs, and a split group
belongs to the step that used up the length, so there are at most two groups
per length.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import join_path, new_work_dir
from .shipping import ship
from .tokens import encoder, vocabulary

CAPACITY = 4096
RANK_GROUP = 100_000  # pieces of one length ranked in one window group
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


def _cutter(path: str, end_id: int, capacity: int, keep_ids: bool):
    def run(batches):
        import pyarrow as pa

        from .textblocks import blocks

        enc, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at, stop, block in blocks(batch):
                cols: list[list] = [[], [], [], [], [], []]
                texts = [block.text_bytes(i) for i in range(len(block))]
                for doc_id, ids in zip(doc_ids[at:stop], enc.encode(texts)):
                    ids += end
                    for k in range(0, len(ids), width):
                        piece = ids[k:k + width]
                        row = (doc_id, k // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                        for col, value in zip(cols, row):
                            col.append(value)
                        if keep_ids:
                            cols[5].append(piece)
                arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    arrays.append(pa.array(cols[5], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def cut_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY,
                  keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids; null text is an empty document,
    which is one piece holding the end id. ``keep_ids`` adds the ids
    (little-endian 32-bit) to each piece."""
    ship(docs.sparkSession)
    schema = PIECES + (", ids binary" if keep_ids else "")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_cutter(path, end_id, capacity, keep_ids), schema)


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used, for ``counts`` pieces per length.

    Longest first; a length fills the packs with the most room left. Where
    none has room, new packs take as many of the length as fit."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # free space -> groups of packs

    def put(pattern: tuple[int, ...], n: int, free: int) -> None:
        if n:
            room.setdefault(free, []).append((pattern, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} outside 1..{capacity}")
        left = counts[length]
        while left > 0:
            free = max(room, default=0)
            if free >= length:
                pattern, n = room[free].pop()
                if not room[free]:
                    del room[free]
                used = min(n, left)
                put(pattern, n - used, free)
                put(pattern + (length,), used, free - length)
                left -= used
            else:
                each = capacity // length
                full, rest = divmod(left, each)
                put((length,) * each, full, capacity - each * length)
                put((length,) * rest, 1 if rest else 0, capacity - rest * length)
                left = 0
    return [group for free in sorted(room) for group in room[free]]


def slot_table(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """One row per slot of a pattern: its length, the first rank it takes, the
    first sequence and the offset. Sorted by (length, first rank)."""
    rows, next_rank, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            low = next_rank.get(length, 0)
            rows.append((length, low, sequence, offset))
            next_rank[length] = low + n
            offset += length
        sequence += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "low", "sequence", "offset"), table.T))


def _placer(slots: dict[str, np.ndarray], keep_ids: bool):
    key = (slots["length"].astype(np.uint64) << np.uint64(48)) + slots["low"].astype(np.uint64)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank")).to_numpy()
            want = (length.astype(np.uint64) << np.uint64(48)) + rank.astype(np.uint64)
            at = np.searchsorted(key, want, side="right") - 1
            sequence = slots["sequence"][at] + rank - slots["low"][at]
            keep = [n for n in names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(names.index(n)) for n in keep),
                 pa.array(sequence), pa.array(slots["offset"][at])],
                names=[*keep, "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = 2,
                   capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Sequences count from 0; offsets in a sequence are gapless from 0. Empty
    and null texts are packed as their end id; an empty table gives no rows.
    Rows that repeat a doc_id are separate documents. Other columns are
    ignored. The pieces are written once to the shared folder."""
    spark = docs.sparkSession
    stored = join_path(new_work_dir(spark, "packing"), "pieces")
    cut_documents(docs, path or vocabulary(), end_id, capacity, keep_ids).write.parquet(stored)
    pieces = spark.read.parquet(stored)
    histogram = {int(r["length"]): int(r["n"]) for r in  # at most `capacity` rows
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = slot_table(pack_histogram(histogram, capacity))
    groups = 1 + sum(histogram.values()) // RANK_GROUP
    keyed = pieces.withColumn("grp", F.pmod(
        F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("int"))
    before = (Window.partitionBy("length").orderBy("grp")
              .rowsBetween(Window.unboundedPreceding, -1))
    base = (keyed.groupBy("length", "grp").agg(F.count("*").alias("n"))
            .select("length", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    within = Window.partitionBy("length", "grp").orderBy("doc_id", "start", "ids_crc32")
    ranked = (keyed.withColumn("local", F.row_number().over(within) - 1)
              .join(base, ["length", "grp"])
              .withColumn("rank", (F.col("base") + F.col("local")).cast("long")))
    names = [n.split()[0] for n in PIECES.split(", ")] + (["ids"] if keep_ids else [])
    schema = PIECES + (", ids binary" if keep_ids else "") + ", sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(_placer(slots, keep_ids), schema)
