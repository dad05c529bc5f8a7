"""Helpers of the operators: lineage cuts in the shared folder and a vectorised word kernel.

The kernel works on the UTF-8 bytes of an Arrow string column. It never builds Python
strings, so its memory is a small multiple of ``BLOCK_BYTES`` however long a text is (one
unbroken word may exceed it).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path
from ledgerloom.sources.tables import delete

BLOCK_BYTES = 1 << 20

#: Whitespace of every contract: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD_REGEX = "[^\\x20\\x09-\\x0D]+"

#: Everything but ASCII letters, digits and the bytes of non-ASCII characters.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

#: Bytes to 1..256, ASCII capitals as small letters.
LOWER = np.arange(1, 257, dtype=np.uint64)
LOWER[65:91] += 32
LOWER_TABLE = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))

_P = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2^64
_P_INV = pow(_P, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there, so a
    lost executor repeats only what follows, and the rows stay the same on every read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs that run in this block send their Python workers so many rows at a time, at most: ten
    thousand texts, the default, take both sides of the pipe over 100 MB a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(was)) if int(was) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def discard(*written: DataFrame) -> None:
    """Remove tables of ``materialise`` that nothing will read again."""
    for df in written:
        delete(df.sparkSession, df.scratch)


def text_hash(col: str = "text"):
    """64-bit hash of a text (null counts as empty), to tell rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def one_text_each(rows: DataFrame) -> DataFrame:
    """One row for each doc_id of ``rows(doc_id, text, ...)``, with the text of the smallest hash:
    an id of many rows takes the place of no other."""
    order = W.partitionBy("doc_id").orderBy(text_hash(), "text")
    return rows.withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth")


def drawn_texts(docs: DataFrame, known: DataFrame, labels: Iterable[int], texts: int, chars: int) -> list:
    """Rows ``(doc_id, label, text)`` to train on, fetched to the driver: of each label at most
    ``texts`` ids of ``known(doc_id, label)``, drawn by a hash of the id among those that have a text
    of at most ``chars`` characters, and one such text of each; by label, then hash."""
    usable = docs.where(F.col("text").isNotNull() & (F.length("text") <= chars))
    with_text = known.join(usable.select("doc_id").distinct(), "doc_id", "left_semi")
    ids = None
    for label in labels:
        some = with_text.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts)
        ids = some if ids is None else ids.unionByName(some)
    # texts ids of each label at most, so the broadcast and what is fetched are bounded
    ids = ids.withColumnRenamed("doc_id", "_id")
    drawn = one_text_each(usable.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).drop("_id"))
    return drawn.select("doc_id", "label", "text").orderBy("label", F.xxhash64("doc_id"), "doc_id").collect()


def row_key(doc_id, content):
    """One string for an id (null as empty) and a hash of the text: a single key shuffles once
    for a join and a grouping that follows it."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), content.cast("string"))


@dataclass
class Block:
    """Texts or pieces of one text: ``rows[i]`` is the row of piece i in the batch."""

    rows: np.ndarray
    buf: np.ndarray
    offsets: np.ndarray


def _last_words(data: np.ndarray, at: int, cut: int, gap: np.ndarray, words: int) -> int:
    """Where the last ``words`` words of ``data[at:cut]`` begin; ``at`` if there are no more."""
    back = 64 * words
    while True:
        low = max(at, cut - back)
        inside = ~gap[data[low:cut]]
        # a word begins after a gap: at the edge of what is looked at only if that is the edge of all
        first = np.flatnonzero(inside & ~np.append(low > at, inside[:-1]))
        if len(first) >= words:
            return low + int(first[-words])
        if low == at:
            return at
        back *= 2


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES, gap: np.ndarray = SPACE, overlap: int = 0) -> Iterator[Block]:
    """The column's texts in blocks of about ``limit`` bytes; a longer text comes in several
    blocks, cut where a ``gap`` byte is, so that no word is cut, each with the last ``overlap``
    words of the one before. Nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(buffers[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(ends, ends[i] + limit, "right")) - 1))
        if ends[j] - ends[i] <= limit:
            yield Block(np.arange(i, j), data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
        else:
            at, stop = int(ends[i]), int(ends[j])
            while at < stop:
                cut = at
                while True:
                    cut = min(cut + limit, stop)
                    while cut < stop:
                        gaps = np.flatnonzero(gap[data[cut : min(cut + limit, stop)]])
                        if len(gaps):
                            cut += int(gaps[0])
                            break
                        cut = min(cut + limit, stop)
                    # half of a block's words at least are new, or it would hardly get on
                    if cut == stop or not overlap or _last_words(data, at, cut, gap, 2 * overlap) > at:
                        break
                yield Block(np.array([i]), data[at:cut], np.array([0, cut - at]))
                at = _last_words(data, at, cut, gap, overlap) if overlap and cut < stop else cut
        i = j


def word_bounds(block: Block, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and per piece the number of words before it."""
    inside = ~gap[block.buf]
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(block.offsets), np.int64)
    first = np.empty(n, bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    edge = block.offsets[:-1]
    first[edge[edge < n]] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = first[1:] | ~inside[1:]
    starts = np.flatnonzero(inside & first)
    # a word ends before a gap or before the next piece
    piece_end = block.offsets[1:] - 1
    last = ~np.append(inside[1:], False)
    last[piece_end[piece_end >= 0]] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


class _Powers:
    """Powers of the polynomial's base and of its inverse, grown as needed. A pickled one is
    empty: these tables stay out of the closures that are sent to tasks."""

    def __init__(self):
        self.tables = {_P: np.ones(1, np.uint64), _P_INV: np.ones(1, np.uint64)}

    def __reduce__(self):
        return _Powers, ()

    def get(self, base: int, n: int) -> np.ndarray:
        if len(self.tables[base]) < n:
            factors = np.full(1 << n.bit_length(), base, np.uint64)
            factors[0] = 1
            self.tables[base] = np.multiply.accumulate(factors)
        return self.tables[base][:n]


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """Hash of each span of bytes, in order of their starts (by default without regard to ASCII
    case): differences of prefix sums of a polynomial modulo 2^64, so the cost does not depend on the
    lengths. A long buffer is taken in stretches, as the sums and powers have 8 bytes a byte."""
    out, lo = np.empty(len(starts), np.uint64), 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + BLOCK_BYTES)))
        a, b = int(starts[lo]), int(ends[lo:hi].max())
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(fold[buf[a:b]] * _powers.get(_P, b - a), out=sums[1:])
        out[lo:hi] = mix((sums[ends[lo:hi] - a] - sums[starts[lo:hi] - a]) * _powers.get(_P_INV, b - a + 1)[starts[lo:hi] - a])
        lo = hi
    return out


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n word hashes, in order: len(words) - n + 1 of them."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = words[:m].copy()
    for k in range(1, n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k : k + m]
    return mix(out)


def restored(cls: type, state: dict):
    """An object of ``cls`` with the given attributes. Broadcasts carry attributes (arrays and
    numbers) alone, as an executor may know no class of this library."""
    out = cls.__new__(cls)
    out.__dict__.update(state)
    return out
