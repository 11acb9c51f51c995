"""Token encoding, plane files (op10) and packing (op6) against the plain library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from linkloom.llm.packing import pack_documents, pack_histogram, slot_table
from linkloom.llm.token_files import (PlaneReader, PlaneWriter, from_planes, read_token_files, to_planes,
                                      token_digest, write_token_files)
from linkloom.llm.tokens import WordEncoder, vocabulary

SF = "/root/testdata/sf0.001"
ODD = ["don't stop we'll O'Neil's 'S 'RE", "abc<|endoftext|> x<|startoftext|>", "ÀÉÎ ß ẞ İ ǅ µm ªº",
       "a b c\x1cd\x85e f", "é éx ́x Σας ΟΔΟΣ", "x1y2 3.14,5 $$$&&& _a_", "", "  \n\t ",
       "日本語テキスト 한국어 العربية हिन्दी", "…—“q” ,,, '", "a" * 500, "\x00\x01 b", "word,word;word!?"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def plain_ids(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def test_encoder_equals_library(tokenizer):
    enc = WordEncoder(vocabulary())
    for _ in range(2):  # the second time from memory
        got = enc.encode([t.encode() for t in ODD])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == \
            [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]


@given(st.lists(st.text(max_size=40), max_size=5))
@settings(max_examples=100, deadline=None)
def test_encoder_equals_library_on_any_text(texts):
    enc = test_encoder_equals_library_on_any_text.__dict__.setdefault("enc", WordEncoder(vocabulary()))
    got = enc.encode([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == \
        [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_small_memory_changes_nothing(tokenizer, monkeypatch):
    import linkloom.llm.tokens as T

    monkeypatch.setattr(T, "MEMORY_WORDS", 3)
    monkeypatch.setattr(T, "MEMORY_PARTS", 2)
    enc = WordEncoder(vocabulary())
    for t in ODD + ODD:
        assert np.frombuffer(enc.encode([t.encode()])[0], "<u4").tolist() == \
            tokenizer.encode(t, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["bit", "byte"]))
@settings(max_examples=100, deadline=None)
def test_planes_round_trip(ids, mode):
    ids = np.array(ids, dtype="<u4")
    assert from_planes(to_planes(ids, mode), len(ids)).tolist() == ids.tolist()


@given(st.lists(st.lists(st.integers(0, 60_000), max_size=40), max_size=30),
       st.sampled_from(["bit", "byte"]), st.sampled_from([1, 7, 16, 1000]))
@settings(max_examples=60, deadline=None)
def test_file_round_trip_and_random_access(docs, mode, chunk):
    writer = PlaneWriter(mode, chunk_ids=chunk)
    for i, ids in enumerate(docs):
        writer.add(None if i % 5 == 4 else i - 2, np.array(ids, "<u4").tobytes())
    reader = PlaneReader(writer.finish())
    at = 0
    for i, (doc_id, start, ids) in enumerate(reader.documents()):
        assert (doc_id, start, ids.tolist()) == (None if i % 5 == 4 else i - 2, at, docs[i])
        assert reader.ids(start, start + len(ids)).tolist() == docs[i]
        at += len(ids)
    flat = [x for d in docs for x in d]
    assert reader.ids(at // 3, at - at // 4).tolist() == flat[at // 3:at - at // 4]


def test_broken_file_is_refused():
    with pytest.raises(ValueError):
        PlaneReader(b"LLPLANE1" + b"x" * 50)


def test_token_digest_equals_library(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in token_digest(docs).collect())
    want, at = [], 0
    for r in sorted(docs.select("doc_id", "text").collect()):
        ids = plain_ids(tokenizer, r.text, 1)
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_token_files_odd_rows(spark, work, tokenizer):
    rows = [(3, "b c", 1), (1, None, 2), (1, "", 3), (None, "x", 4), (7, "z " * 5000, 5), (3, "b c", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    manifest = write_token_files(docs, work, vocabulary(), ids_per_file=3)
    got = [tuple(r) for r in read_token_files(spark, work, manifest).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, 1, 1, 3, 3, 7]
    assert [r[2] for r in got] == [2, 1, 1, 3, 3, 5001]
    assert [r[1] for r in got] == [0, 2, 3, 4, 7, 10]
    empty = docs.limit(0)
    assert token_digest(empty).count() == 0


def check_packs(rows, capacity):
    packs = {}
    for r in rows:
        packs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pack in packs.values():
        at = 0
        for offset, length in sorted(pack):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(packs) == list(range(len(packs)))
    return packs


def test_packing_holds_every_id_once(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pack_documents(docs).collect()
    packs = check_packs(rows, 4096)
    ids = {r.doc_id: plain_ids(tokenizer, r.text, 2) for r in docs.collect()}
    seen = {}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
    for doc_id, parts in seen.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(ids[doc_id])
    assert seen.keys() == ids.keys()
    total = sum(map(len, ids.values()))
    assert total / (4096 * len(packs)) > 0.95


def test_packing_odd_rows(spark):
    rows = [(1, None, 9), (1, "", 9), (None, "x y", 9), (2, "w " * 100, 9), (2, "w " * 100, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = pack_documents(docs, capacity=16, keep_ids=True).collect()
    check_packs(got, 16)
    assert sum(r.length for r in got) == 1 + 1 + 3 + 101 + 101
    assert all(len(r.ids) == 4 * r.length for r in got)
    assert pack_documents(docs.limit(0)).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
@settings(max_examples=150, deadline=None)
def test_histogram_packing(counts):
    patterns = pack_histogram(counts, 64)
    used = {}
    for pattern, n in patterns:
        assert sum(pattern) <= 64
        for length in pattern:
            used[length] = used.get(length, 0) + n
    assert used == counts
    assert len(patterns) <= 3 * len(counts)
    slots = slot_table(patterns)
    ranks = {}
    for length, low in zip(slots["length"], slots["low"]):
        ranks.setdefault(int(length), []).append(int(low))
    assert all(sorted(v)[0] == 0 for v in ranks.values())


def test_one_length_is_packed_tight():
    assert sum(n for _, n in pack_histogram({100: 1000}, 4096)) == 25
