"""Token-ID / binary output: bit-plane shuffled id files.

File format (little-endian)::

    magic  "LLPLANE1"
    chunks fixed-size blocks of ids, each as planes: the block's ids are a
           bit matrix (ids x 32); transposed, every bit position (mode "bit")
           or byte position (mode "byte") is one contiguous plane, compressed
           on its own with zstandard. All-zero planes are stored empty.
    index  int64 arrays, compressed: per chunk the byte offset, first id and
           number of ids, and the length of every plane; per document its
           id, whether that id is null, and its number of tokens
    tail   uint64 index offset, uint64 index length, uint32 number of
           planes, uint32 chunk size, magic

The chunk index gives random access: any id range is read by decoding only
the chunks it touches.

Writing: documents are dealt out by ranges of doc_id and sorted, each task
writes whole files under a temporary name and renames them, so a task that
is run again (lost executor, speculation) leaves the same file. The
manifest, a table, names the files that count and their order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import join_path, new_work_dir
from .shipping import ship
from .tokens import encoder, vocabulary

MAGIC = b"LLPLANE1"
CHUNK_IDS = 1 << 16
IDS_PER_FILE = 1 << 21
TAIL = struct.Struct("<QQII8s")
MANIFEST = ("file string, part int, seq int, n_docs long, n_ids long, n_bytes long")
READ_BACK = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, mode: str) -> list[np.ndarray]:
    """Transpose one block: 32 bit planes or 4 byte planes, least significant first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if mode == "byte":
        return [np.ascontiguousarray(raw[:, k]) for k in range(4)]
    planes = []
    for k in range(4):  # eight bits at a time
        bits = np.unpackbits(np.ascontiguousarray(raw[:, k]).reshape(-1, 1), axis=1,
                             bitorder="little")
        packed = np.packbits(np.ascontiguousarray(bits.T), axis=1)
        planes.extend(packed[j] for j in range(8))
    return planes


def from_planes(planes: list[np.ndarray | None], n: int) -> np.ndarray:
    """Inverse of ``to_planes``; None is an all-zero plane."""
    raw = np.zeros((n, 4), dtype=np.uint8)
    if len(planes) == 4:
        for k, plane in enumerate(planes):
            if plane is not None:
                raw[:, k] = plane
    else:
        for k in range(4):
            for j in range(8):
                plane = planes[8 * k + j]
                if plane is not None:
                    raw[:, k] |= np.unpackbits(plane, count=n) << np.uint8(j)
    return raw.reshape(-1).view("<u4").copy()


class PlaneWriter:
    """Builds one file in memory (bounded by the ids per file)."""

    def __init__(self, mode: str = "bit", chunk_ids: int = CHUNK_IDS, level: int = 3):
        import zstandard

        self.zstd = zstandard.ZstdCompressor(level=level)
        self.mode, self.chunk_ids = mode, chunk_ids
        self.parts, self.size = [MAGIC], len(MAGIC)
        self.pending: list[bytes] = []
        self.pending_ids = self.n_ids = 0
        self.chunks: list[tuple[int, int, int]] = []
        self.plane_sizes: list[list[int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((0 if doc_id is None else doc_id, int(doc_id is None), n))
        self.pending.append(ids)
        self.pending_ids += n
        self.n_ids += n
        if self.pending_ids >= self.chunk_ids:
            self._flush(False)

    def _flush(self, rest: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), dtype="<u4")
        at = 0
        while len(ids) - at >= self.chunk_ids or (rest and at < len(ids)):
            block = ids[at:at + self.chunk_ids]
            self.chunks.append((self.size, self.n_ids - self.pending_ids + at, len(block)))
            sizes = []
            for plane in to_planes(block, self.mode):
                packed = self.zstd.compress(plane.tobytes()) if plane.any() else b""
                self.parts.append(packed)
                sizes.append(len(packed))
            self.size += sum(sizes)
            self.plane_sizes.append(sizes)
            at += len(block)
        self.pending = [ids[at:].tobytes()]
        self.pending_ids = len(ids) - at

    def finish(self) -> bytes:
        self._flush(True)
        n_planes = 4 if self.mode == "byte" else 32
        head = np.array([len(self.chunks), len(self.docs)], dtype="<i8")
        index = self.zstd.compress(b"".join((
            head.tobytes(),
            np.array(self.chunks, dtype="<i8").reshape(-1, 3).tobytes(),
            np.array(self.plane_sizes, dtype="<i8").reshape(-1, n_planes).tobytes(),
            np.array(self.docs, dtype="<i8").reshape(-1, 3).T.tobytes())))
        tail = TAIL.pack(self.size, len(index), n_planes, self.chunk_ids, MAGIC)
        return b"".join((*self.parts, index, tail))


class PlaneReader:
    """Random access to one file's ids by its chunk index."""

    def __init__(self, blob: bytes):
        import zstandard

        self.blob, self.zstd = blob, zstandard.ZstdDecompressor()
        at, length, self.n_planes, self.chunk_ids, magic = TAIL.unpack(blob[-TAIL.size:])
        if magic != MAGIC or blob[:len(MAGIC)] != MAGIC:
            raise ValueError("not a plane file")
        index = np.frombuffer(self.zstd.decompress(blob[at:at + length]), dtype="<i8")
        n_chunks, n_docs = int(index[0]), int(index[1])
        rest = index[2:]
        self.chunks = rest[:3 * n_chunks].reshape(-1, 3)
        rest = rest[3 * n_chunks:]
        self.sizes = rest[:self.n_planes * n_chunks].reshape(-1, self.n_planes)
        docs = rest[self.n_planes * n_chunks:].reshape(3, n_docs)
        self.doc_ids, self.doc_null, self.doc_tokens = docs[0], docs[1].astype(bool), docs[2]

    def chunk(self, k: int) -> np.ndarray:
        offset, _, n = (int(x) for x in self.chunks[k])
        width = n if self.n_planes == 4 else (n + 7) // 8
        planes: list[np.ndarray | None] = []
        for size in self.sizes[k]:
            piece = self.blob[offset:offset + int(size)]
            planes.append(np.frombuffer(self.zstd.decompress(piece, max_output_size=width), np.uint8)
                          if size else None)
            offset += int(size)
        return from_planes(planes, n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, dtype="<u4")
        first = np.searchsorted(self.chunks[:, 1], start, side="right") - 1
        last = np.searchsorted(self.chunks[:, 1], stop, side="left")
        got = np.concatenate([self.chunk(k) for k in range(first, last)])
        base = int(self.chunks[first, 1])
        return got[start - base:stop - base]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id in this file, ids), decoding each chunk once."""
        ends = np.cumsum(self.doc_tokens)
        k, have, base = 0, np.zeros(0, dtype="<u4"), 0
        for i, end in enumerate(ends):
            n, end = int(self.doc_tokens[i]), int(end)
            start = end - n
            pieces = [have[start - base:]] if start - base < len(have) else []
            while base + len(have) < end:
                base += len(have)
                have = self.chunk(k)
                pieces.append(have)
                k += 1
            ids = np.concatenate(pieces) if pieces else np.zeros(0, dtype="<u4")
            yield (None if self.doc_null[i] else int(self.doc_ids[i])), start, ids[:n]


def _file_writer(target: str, path: str, end_id: int, mode: str, ids_per_file: int):
    def run(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        from .textblocks import blocks

        part = TaskContext.get().partitionId()
        filesystem, root = pafs.FileSystem.from_uri(target)
        enc, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
        writer, seq, done = PlaneWriter(mode), 0, []

        def close():
            nonlocal writer, seq
            blob = writer.finish()
            name = f"part-{part:06d}-{seq:06d}.planes"
            tmp = f"{root}/.{name}.{uuid.uuid4().hex[:8]}"
            with filesystem.open_output_stream(tmp) as out:
                out.write(blob)
            if filesystem.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound:
                filesystem.delete_file(f"{root}/{name}")  # an earlier attempt of this task
            filesystem.move(tmp, f"{root}/{name}")
            done.append((name, part, seq, len(writer.docs), writer.n_ids, len(blob)))
            writer, seq = PlaneWriter(mode), seq + 1

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at, stop, block in blocks(batch):
                texts = [block.text_bytes(i) for i in range(len(block))]
                for doc_id, ids in zip(doc_ids[at:stop], enc.encode(texts)):
                    writer.add(doc_id, ids + end)
                    if writer.n_ids >= ids_per_file:
                        close()
        if writer.docs:
            close()
        names = [f.split()[0] for f in MANIFEST.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        schema = pa.schema(list(zip(names, kinds)))
        yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in done], schema=schema)

    return run


def _file_system_uri(spark: SparkSession, folder: str) -> str:
    """Make the folder and name it the way ``pyarrow.fs`` does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    scheme, rest = fs.makeQualified(path).toString().split(":", 1)
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"s3:{rest}" if scheme in ("s3a", "s3n") else f"{scheme}:{rest}"


def write_token_files(docs: DataFrame, target: str, path: str, end_id: int = 1,
                      mode: str = "byte", ids_per_file: int = IDS_PER_FILE) -> DataFrame:
    """Encode all documents (null text: empty) in ascending doc_id order into
    plane files below ``target`` (a URI every executor can write) and return
    the manifest with each file's ``first_id``.

    Null doc_ids come first; rows that share a doc_id are ordered by
    their text's checksum.
    An empty table gives an empty manifest. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    uri = _file_system_uri(spark, join_path(target, "files"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The checksum spreads rows that share a doc_id (or have none) and keeps texts out of the
    # sample from which Spark takes the ranges.
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    manifest = join_path(target, "manifest")
    ordered.mapInArrow(_file_writer(uri, path, end_id, mode, ids_per_file),
                       MANIFEST).write.parquet(manifest)
    return file_offsets(spark.read.schema(MANIFEST).parquet(manifest))


def file_offsets(manifest: DataFrame) -> DataFrame:
    """First id of each file: ids of earlier parts plus ids of earlier files in
    the part. Only one row per part meets in the part-level window."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
             .select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_first")))
    within = (Window.partitionBy("part").orderBy("seq")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (manifest.withColumn("in_part", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
            .join(parts, "part")
            .withColumn("first_id", F.col("part_first") + F.col("in_part"))
            .drop("part_first", "in_part"))


def _decode(batches):
    import pyarrow as pa

    for batch in batches:
        firsts = batch.column(1).to_pylist()
        for k, first in enumerate(firsts):
            rows = []
            for doc_id, start, ids in PlaneReader(batch.column(0)[k].as_py()).documents():
                rows.append((doc_id, first + start, len(ids), zlib.crc32(ids.tobytes())))
            ids_, starts, counts, crcs = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (ids_, starts, counts, crcs)],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, target: str, manifest: DataFrame) -> DataFrame:
    """One row per document, decoded from the files the manifest names."""
    ship(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.planes")
             .load(join_path(target, "files"))
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))
    named = files.join(manifest.select("file", "first_id"), "file").select("content", "first_id")
    return named.mapInArrow(_decode, READ_BACK)


def token_digest(docs: DataFrame, path: str | None = None, end_id: int = 1) -> DataFrame:
    """Write the files, read them back, digest what was read."""
    spark = docs.sparkSession
    target = new_work_dir(spark, "token-files")
    manifest = write_token_files(docs, target, path or vocabulary(), end_id)
    return read_token_files(spark, target, manifest)
