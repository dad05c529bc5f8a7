"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are runs of ASCII letters and digits and of non-ASCII characters, without regard to
ASCII case, so that punctuation and spacing make no difference.

* Item lengths fall into classes about 12 % apart. For each class, windows of that many words
  are laid over every text, an eighth of a window apart, and get a 64-bit SimHash of their word
  pairs.
* The items' fingerprints are indexed in 4 blocks of 16 bits, a few items at a time: each block's
  table has every value's distance from the nearest of these items' blocks. The distance from an
  item is at least the sum of the four, so no fingerprint within RADIUS = 15 bits is missed
  where windows of a larger sum are passed over; the others are compared on all 64 bits.
* A candidate is verified against windows of exactly the item's length around it: weighted
  Jaccard similarity of their word shingles (a shingle weighs as often as it occurs) of at
  least the threshold.

One narrow pass over the texts; only the matches are shuffled. The items are sent to the tasks
in blocks of at most ITEM_BYTES of text, one pass for each block, so that no broadcast grows
with the benchmark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import LOWER, NOT_WORD, ngram_hashes, span_hashes, text_blocks, text_hash, word_bounds

RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
#: Items that share their blocks' tables: with fewer the tables tell more windows apart.
SHARED = 8
ITEM_BYTES = 1 << 20
CLASS_STEP = 1.12
#: Words that are handled at a time.
CHUNK = 1 << 17


def lengths(most: int) -> list[int]:
    """The classes' window lengths: every length up to 8, then about 12 % apart."""
    out = list(range(1, 9))
    while out[-1] < most:
        out.append(max(out[-1] + 1, round(out[-1] * CLASS_STEP)))
    return out


#: Every 16th bit: four counters in one word.
_LANES = np.uint64(0x0001000100010001)


def _prefix_sums(features: np.ndarray) -> np.ndarray:
    """Row i: for each bit, how many of the first i features have it; 16 words of four 16-bit
    counters. Counters run over into their neighbours, but differences of two rows are exact
    where they count fewer than 65,536 features, as the carries in both are the same."""
    out = np.zeros((len(features) + 1, 16), np.uint64)
    np.bitwise_and(features[:, None] >> np.arange(16, dtype=np.uint64), _LANES, out=out[1:])
    return np.cumsum(out, axis=0, dtype=np.uint64, out=out)


def _fingerprints(counts: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """Bits that more than half of the ``n`` features have, from differences of prefix sums. (The
    order of the bits is that of the counters.)"""
    half = np.asarray(n, np.uint16) // 2
    set_ = counts.view(np.uint16).reshape(len(counts), 64) > half.reshape(-1, 1)
    return np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()


class Index:
    """A block of items, ready to be searched for. ``items``: word hashes by item."""

    def __init__(self, items: list[tuple[int, np.ndarray]], shingle: int, threshold: float):
        self.shingle, self.threshold = shingle, threshold
        self.items = [(i, w, Counter(self.shingles(w, len(w)).tolist())) for i, w in items if len(w)]
        self.longest = max((len(w) for _, w, _ in self.items), default=0)
        self.classes: list[tuple[int, list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]]] = []
        sizes = np.array(lengths(self.longest))
        of = np.array([int(np.abs(sizes - len(w)).argmin()) for _, w, _ in self.items], int)
        values = np.arange(1 << BLOCK_BITS, dtype=np.uint16)
        for c in np.unique(of):
            own = np.flatnonzero(of == c)
            prints = np.concatenate([self.one(self.items[k][1]) for k in own])
            groups = []
            for at in range(0, len(own), SHARED):
                some, fps = own[at : at + SHARED], prints[at : at + SHARED]
                blocks = fps.view(np.uint16).reshape(-1, BLOCKS)
                least = [np.bitwise_count(values ^ blocks[:, b, None]).min(axis=0) for b in range(BLOCKS)]
                groups.append((some, fps, least))
            self.classes.append((int(sizes[c]), groups))

    @staticmethod
    def one(words: np.ndarray) -> np.ndarray:
        """The fingerprint of a text's word pairs; a single word's is its hash."""
        return _fingerprints(_prefix_sums(ngram_hashes(words, 2))[-1:], len(words) - 1) if len(words) > 1 else words

    def shingles(self, words: np.ndarray, length: int) -> np.ndarray:
        """Of a text that is ``length`` words long or longer."""
        return ngram_hashes(words, min(self.shingle, length))

    @staticmethod
    def similarity(mine: Counter, item: Counter) -> float:
        both = sum(min(n, item[x]) for x, n in mine.items() if x in item)
        return both / max(mine.total() + item.total() - both, 1)

    def search(self, words: np.ndarray, doc_starts: np.ndarray) -> dict[tuple[int, int], float]:
        """{(text, item): best similarity} over texts whose words stand one after another."""
        found: dict[tuple[int, int], float] = {}
        n = len(words)
        if not n or not self.items:
            return found
        sums = _prefix_sums(ngram_hashes(words, 2))
        for size, groups in self.classes:
            step = max(1, size // 8)
            # windows may reach into the next text: the check stays within one
            grid = np.arange(0, max(1, n - size + 1), step)
            flush = np.maximum(np.append(doc_starts[1:], n) - size, 0)  # flush with each text's end
            for lo in range(0, len(grid), 1 << 15):
                at = grid[lo : lo + (1 << 15)]
                first, last = int(at[0]), int(at[-1])
                counts = sums[min(first + size, n) - 1 : last + size : step] - sums[first : last + 1 : step]
                self.probe(words, doc_starts, at, counts, min(size, n) - 1, size, groups, found)
            ends = np.minimum(flush + size, n) - 1
            self.probe(words, doc_starts, flush, sums[ends] - sums[flush], ends - flush, size, groups, found)
        return found

    def probe(self, words, doc_starts, at, counts, pairs, size, groups, found) -> None:
        """Windows that start at ``at``, with the counts of their word pairs' bits, against one class
        of items."""
        fp = _fingerprints(counts, pairs) if size > 1 else words[at]
        blocks = [fp.view(np.uint16).reshape(-1, BLOCKS)[:, b].astype(np.intp) for b in range(BLOCKS)]
        for own, prints, least in groups:
            bound = least[0].take(blocks[0])
            for b in range(1, BLOCKS):
                bound += least[b].take(blocks[b])
            hit = np.flatnonzero(bound <= RADIUS)
            if not len(hit):
                continue
            rows, items = np.nonzero(np.bitwise_count(fp[hit, None] ^ prints) <= RADIUS)
            for k in np.unique(items):
                self.verify(words, doc_starts, at[hit[rows[items == k]]], size, max(1, size // 8), int(own[k]), found)

    def verify(self, words, doc_starts, at, size, step, item, found) -> None:
        """The best similarity of windows of the item's length that start near those given."""
        item_id, own, counts = self.items[item]
        length = len(own)
        slack = step + abs(size - length)
        tried = set()
        for near in at.tolist():
            # the text or texts that the window lies in
            for doc in range(np.searchsorted(doc_starts, near, "right") - 1, np.searchsorted(doc_starts, near + size, "left")):
                first = int(doc_starts[doc])
                last = int(doc_starts[doc + 1]) if doc + 1 < len(doc_starts) else len(words)
                stop = max(first, last - length)
                if first == last:
                    continue
                lo, hi = min(max(first, near - slack), stop), min(max(first, near + slack), stop)
                shingles = self.shingles(words[lo : min(hi + length, last)], min(length, last - first)).tolist()
                # at least this share of the item's shingles has to be there
                if sum(map(counts.__contains__, shingles)) < self.threshold * counts.total():
                    continue
                per = min(length, last - first) - min(self.shingle, length, last - first) + 1
                for start in range(lo, hi + 1):
                    if (doc, start) not in tried:
                        tried.add((doc, start))
                        like = self.similarity(Counter(shingles[start - lo : start - lo + per]), counts)
                        if like >= self.threshold and like > found.get((doc, item_id), 0):
                            found[doc, item_id] = like


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of each text, one entry for each piece of a very long one."""
    for block in text_blocks(column, gap=NOT_WORD):
        starts, ends, per = word_bounds(block, NOT_WORD)
        hashes = span_hashes(block.buf, starts, ends, LOWER)
        for k, row in enumerate(block.rows.tolist()):
            yield row, hashes[per[k] : per[k + 1]]


def _runs(column: pa.Array, overlap: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(rows, doc starts, words): texts one after another, about CHUNK words at a time. A text
    that goes on in the next run has its last ``overlap`` words repeated there."""
    rows: list[int] = []
    parts: list[np.ndarray] = []
    size, before, tail = 0, -1, None
    for row, words in word_hashes(column):
        if row == before:
            words = np.concatenate([tail, words])
        before, tail = row, words[-overlap:]
        rows.append(row)
        parts.append(words)
        size += len(words)
        if size >= CHUNK:
            yield rows, np.cumsum([0, *map(len, parts[:-1])]), np.concatenate(parts)
            rows, parts, size = [], [], 0
    if rows:
        yield rows, np.cumsum([0, *map(len, parts[:-1])]), np.concatenate(parts)


class Search:
    """A block of items for the tasks; the index is built once in each."""

    def __init__(self, items: list[tuple[int, bytes]], shingle: int, threshold: float):
        none = np.zeros(0, np.uint64)
        self.items = [(i, np.concatenate([h for _, h in word_hashes(pa.array([t], pa.string()))] or [none])) for i, t in items]
        self.shingle, self.threshold, self.index = shingle, threshold, None

    def found(self, texts: pa.Array) -> dict[tuple[int, int], float]:
        """{(row, item): best similarity} of the texts that hold a passage like an item."""
        if self.index is None:
            self.index = Index(self.items, self.shingle, self.threshold)
        out: dict[tuple[int, int], float] = {}
        for rows, starts, words in _runs(texts, 2 * self.index.longest + 2):
            for (doc, item), like in self.index.search(words, starts).items():
                key = rows[doc], item
                out[key] = max(like, out.get(key, 0.0))
        return out


def _searches(benchmark: DataFrame, shingle: int, threshold: float) -> list[Search]:
    """The usable items in blocks of about ITEM_BYTES; a block at a time is held in the driver."""
    items = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    held = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    return [Search([tuple(r) for r in held.where(F.col("block") == b).drop("block").collect()], shingle, threshold) for b in range(blocks)]


def _found(docs: DataFrame, search: Search) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = search.found(b.column(1))
            take = pa.array([r for r, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(2).take(take), pa.array([i for _, i in found], pa.int64()), pa.array(list(found.values()), pa.float64())],
                ["doc_id", "text_hash", "item_id", "similarity"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash().alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, item_id long, similarity double")


def _clean(docs: DataFrame, search: Search) -> DataFrame:
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[row for row, _ in search.found(b.column(at))]] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def matches(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``(doc_id, text_hash, item_id, similarity)`` of every text of ``docs(doc_id, text, ...)``
    that holds a passage like an item of ``benchmark(item_id, text, ...)``: the best similarity.

    A text shorter than an item is compared as a whole; an item of fewer words than a shingle
    is one shingle, and matches its exact word sequence. Null and empty texts and items match
    nothing; items with a null id are left out. Rows equal in doc_id and text give one row per
    item; a null doc_id is kept. Extra columns are ignored; an empty table gives no row.
    """
    found = [_found(docs, search) for search in _searches(benchmark, shingle, threshold)]
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "text_hash", "item_id").agg(F.max("similarity").alias("similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``(doc_id, item_id, similarity)``: ``matches`` without the text hash (repeated ids merge)."""
    return matches(docs, benchmark, shingle, threshold).groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage; each pass drops what it finds, so
    nothing is shuffled."""
    return reduce(_clean, _searches(benchmark, shingle, threshold), docs)
