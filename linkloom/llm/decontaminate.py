"""Benchmark decontamination: pigeonhole edit matching.

A test item of m characters leaks into a text when some substring of the
text is within k = floor(rate * m) edits of it. Cut the item into k + 1
pieces: k edits leave one piece untouched, so every leak shows an exact hit
of a piece close to where that piece belongs. An Aho-Corasick automaton finds
all piece hits in one pass over the text; the window around each (window
overlaps merged, by item) is verified with Myers' bit-parallel distance. In a
window every match is reported that overlaps no other: exact ones from left to
right, then, in the stretches between them, the others by distance.

Items of fewer than ``SHORT_CHARS`` characters have no budget and match as
whole words only: an edit, or a word that happens to contain them, proves
nothing. A match of an item of fewer than ``PASSAGE_CHARS`` is reported, but
makes no document go (``without_leaks``): a word or two are no passage.

Both sides are compared in lower case with white space runs as one space.
Documents are scanned where they lie: no shuffle. Test items are taken in
blocks of a bounded size, each a pass over the documents whose matches are
written before the next, so neither a task nor the driver holds more of the
benchmark than a block.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .store import Store

ERROR_RATE = 0.08
SHORT_CHARS = 40
PASSAGE_CHARS = 20
BLOCK_CHARS = 4_000_000
LEAKS = "doc_id long, item_id long, distance int, start int, end int"


def normalise(text: str) -> str:
    return " ".join(fold(text).split())


def fold(text: str) -> str:
    """Lower case, character by character where the length would change."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low


def places(text: str) -> list[int]:
    """Position in ``text`` of each character of ``normalise(text)``, and the end."""
    out, gap = [], None
    for i, c in enumerate(text):
        if c.isspace():
            gap = i if gap is None else gap
        else:
            if gap is not None and out:
                out.append(gap)
            gap = None
            out.append(i)
    return out + [out[-1] + 1 if out else 0]


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 parts of nearly equal length with their offsets."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit-parallel search for one item."""

    def __init__(self, text: str):
        self.text, self.m = text, len(text)
        self.ones = (1 << self.m) - 1
        self.high = 1 << (self.m - 1)
        self.bits: dict[str, int] = {}
        for i, c in enumerate(text):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def ends(self, window: str, most: int) -> list[tuple[int, int]]:
        """(distance, end) of every place where a match within ``most`` edits ends."""
        pv, mv, score, out = self.ones, 0, self.m, []
        ones, high, bits = self.ones, self.high, self.bits
        for j, c in enumerate(window, 1):
            eq = bits.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (ones & ~(xh | pv))
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            if score <= most:
                out.append((score, j))
            ph = ph << 1 & ones
            mh = mh << 1 & ones
            pv = mh | (ones & ~(xv | ph))
            mv = ph & xv
        return out

    def best_end(self, window: str) -> tuple[int, int]:
        """Least distance of a substring of ``window``, and its first end."""
        pv, mv, score, best = self.ones, 0, self.m, (self.m, 0)
        ones, high, bits = self.ones, self.high, self.bits
        for j, c in enumerate(window, 1):
            eq = bits.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (ones & ~(xh | pv))
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
                if score < best[0]:
                    best = score, j
            ph = ph << 1 & ones
            mh = mh << 1 & ones
            pv = mh | (ones & ~(xv | ph))
            mv = ph & xv
        return best


class Matcher:
    """Piece automaton and patterns of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least_chars: int = 1,
                 short_chars: int = SHORT_CHARS):
        import ahocorasick

        self.short_chars = short_chars

        self.automaton = ahocorasick.Automaton()
        self.items: list[tuple[int, str, int]] = []
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normalise(text or "")
            if len(item) < least_chars:
                continue
            errors = int(rate * len(item)) if len(item) >= short_chars else 0
            for offset, piece in pieces(item, errors):
                owners.setdefault(piece, []).append((len(self.items), offset + len(piece)))
            self.items.append((item_id, item, errors))
        for piece, places_ in owners.items():
            self.automaton.add_word(piece, places_)
        if owners:
            self.automaton.make_automaton()

    def _search(self, k: int, text: str, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """(distance, start, end) of the matches of item k in text[low:high]."""
        _, item, errors = self.items[k]
        free, at = low, text.find(item, low, high)
        while True:
            stop = high if at < 0 else at
            if errors and stop > free:
                yield from self._near(k, text, free, stop)
            if at < 0:
                return
            free = at + len(item)
            if len(item) >= self.short_chars or self._whole(text, at, free):
                yield 0, at, free
            at = text.find(item, free, high)

    @staticmethod
    def _whole(text: str, start: int, end: int) -> bool:
        """Whether no word reaches over an edge of text[start:end]."""
        return not (start and text[start - 1].isalnum() and text[start].isalnum()
                    or end < len(text) and text[end - 1].isalnum() and text[end].isalnum())

    def _near(self, k: int, text: str, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """Matches with edits, in a stretch without an exact one."""
        _, item, errors = self.items[k]
        if high - low < len(item) - errors:
            return
        if k not in self.patterns:
            self.patterns[k] = Pattern(item), Pattern(item[::-1])
        forward, backward = self.patterns[k]
        window = text[low:high]
        taken = [(0, 0), (len(window), len(window))]  # sorted, without overlap
        for _, end in sorted(forward.ends(window, errors)):
            i = bisect_left(taken, (end, 0))
            if taken[i - 1][1] >= end or i < len(taken) and taken[i][0] < end:
                continue
            back = window[max(taken[i - 1][1], end - len(item) - errors):end][::-1]
            distance, length = backward.best_end(back)
            if distance <= errors:
                taken.insert(i, (end - length, end))
                yield distance, low + end - length, low + end

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) in normalised text of every match;
        the matches of an item do not overlap."""
        if not self.items:
            return []
        starts: dict[int, list[int]] = {}
        for end, hits in self.automaton.iter(text):
            for k, upto in hits:
                starts.setdefault(k, []).append(end + 1 - upto)
        out = []
        for k, found in starts.items():
            item_id, item, errors = self.items[k]
            found.sort()
            low, high = None, None
            for s in [*found, None]:
                if s is not None and high is not None and s - errors <= high:
                    high = s + len(item) + errors
                    continue
                if high is not None:
                    out += [(item_id, *hit) for hit in self._search(k, text, max(0, low), min(high, len(text)))]
                if s is not None:
                    low, high = s - errors, s + len(item) + errors
        return out


def _scanner(items: list[tuple[int, str]], rate: float):
    def run(batches):
        import pyarrow as pa

        matcher = Matcher(items, rate)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                found = matcher.find(normalise(text))
                if found:
                    place = places(text)
                    rows += [(doc_id, item_id, d, place[a], place[b - 1] + 1 if b else place[a])
                             for item_id, d, a, b in sorted(found, key=lambda r: (r[2], r[0]))]
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "item_id", "distance", "start", "end"])

    return run


def _cleaner(items: list[tuple[int, str]], rate: float, least_chars: int):
    def run(batches):
        import pyarrow as pa

        matcher = Matcher(items, rate, least_chars)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([not matcher.find(normalise(t.as_py() or "")) for t in texts],
                                        pa.bool_()))

    return run


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``BLOCK_CHARS`` characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = 1 + int(chars) // BLOCK_CHARS
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for i in range(n_blocks):
        yield [(r["item_id"], r["text"])
               for r in items.where(block == i).orderBy("item_id", "text").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """One row per match: doc_id, item_id, least distance, start and end in
    the document's text (code points, end exclusive).

    Null and empty texts hold no leak; null, empty and blank items match
    nothing. Rows that repeat a doc_id or an item_id are each searched, so
    ties and repeats give a row each. Other columns are ignored. An empty
    benchmark or table gives no rows."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    store, found = Store(spark, "leaks"), None
    for items in item_blocks(benchmark):
        mine = rows.mapInArrow(_scanner(items, rate), LEAKS)
        if found is None:
            found = mine
            continue
        if store.n == 0:  # a second block: each is written by itself
            found = store.keep(found, "block")
        found = found.unionByName(store.keep(mine, "block"))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE,
                  least_chars: int = PASSAGE_CHARS) -> DataFrame:
    """The rows, with their columns, whose text holds no match of an item of
    at least ``least_chars`` characters.

    Rows with null or empty text stay, and so do all rows where the benchmark
    is empty; repeated rows stay or go together; columns of any name pass
    through; an empty table stays empty."""
    spark = docs.sparkSession
    ship(spark)
    store, first = Store(spark, "clean"), True
    for items in item_blocks(benchmark):
        if not first:
            docs = store.keep(docs, "block")
        docs, first = docs.mapInArrow(_cleaner(items, rate, least_chars), docs.schema), False
    return docs
