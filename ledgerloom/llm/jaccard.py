"""N-gram Jaccard join with vertical partitioning.

A document's set is its distinct shingles, as 64-bit hashes; equal sets are one from the start.

1. The n-grams get one global order, rare ones first: by a level taken from a count sketch of
   all sets (a bounded table of signed counters, so that its error grows with the square root of
   the corpus only), within a level by hash. Fragments of the order are the rare n-grams and the
   frequent ones, each in hash ranges, as many as keep a fragment of a set to some ``PIECE`` n-grams.
2. Two sets at the threshold have an n-gram in common among the first of each (its head, a fifth
   of a set at 0.8). Heads are counted by n-gram; what no second set has is dropped.
3. Stars: an n-gram is led by the set that has the fewest n-grams before it, so that of near
   copies of one text it is the one with the fewest n-grams of its own; each set is held against
   the set that leads most of its n-grams. Thousands of near copies so become one class with
   one comparison each.
4. What is left are pairs of different classes that meet in a head: for each n-gram, the sets
   outside its largest class against all. Pairs within a class need no comparison, so no group is
   expanded. What stands before the first n-gram in common is not in the other set, which bounds
   the overlap, and few pairs pass.
   What the heads of a pair have in common, and what can be left behind them, bounds it again.
5. A comparison is vertical: the fragments of both sets are joined fragment by fragment, the
   partial overlaps counted apart and summed per pair, and the sum decides exactly.
6. Connected components over the links.

The passes over the texts recompute the sets, which costs less than to store them; that of the
comparisons looks at the texts of the sets to compare only, and cuts a set as its pairs need it. The
fragments are dealt once, by set and fragment: the pairs, which are short, go to those of one of
their sets, and only what they fetch there goes on to those of the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.graph import connected_components
from ledgerloom.llm.shared import discard, materialise, mix, ngram_hashes, small_batches, span_hashes, text_blocks, text_hash, word_bounds

SHINGLE, PERCENT = 5, 80
#: N-grams of a set in one fragment, about: what a row of a comparison holds.
PIECE = 256
#: Counters of the sketch, and bits of the tables that tell which n-grams and sets still matter.
CELLS, BITS = 1 << 22, 1 << 26
#: Counters or bytes of a table that travel as one row.
SLICE = 1 << 14
#: Bytes of text that are hashed at a time.
BLOCK = 1 << 18
#: Rounds of stars at most; there is another only after one that linked half of its pairs.
STARS = 6
#: Sets that a task remembers, to pass over copies.
SEEN = 1 << 16

Kernel = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


# ------------------------------------------------------------------ sets


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its distinct shingles as sorted hashes); fewer words than a shingle are one shingle."""

    def closed(row: int, parts: list[np.ndarray], tail: np.ndarray) -> tuple[int, np.ndarray]:
        if not parts:
            return row, ngram_hashes(tail, len(tail)) if len(tail) else np.zeros(0, np.uint64)
        return row, np.unique(np.concatenate(parts) if len(parts) > 1 else parts[0])

    held: tuple[int, list[np.ndarray], np.ndarray] | None = None
    for block in text_blocks(column, BLOCK):
        starts, ends, per = word_bounds(block)
        words = span_hashes(block.buf, starts, ends)
        grams = ngram_hashes(words, size)
        for k, row in enumerate(block.rows.tolist()):
            lo, hi = int(per[k]), int(per[k + 1])
            if held is not None and held[0] == row:  # a long text goes on
                run = np.concatenate([held[2], words[lo:hi]])
                more = np.unique(ngram_hashes(run, size))
                held = (row, [*held[1], more] if len(more) else held[1], run[-(size - 1) :])
                continue
            if held is not None:
                yield closed(*held)
            held = (row, [grams[lo : hi - size + 1]] if hi - lo >= size else [], words[max(lo, hi - size + 1) : hi])
    if held is not None:
        yield closed(*held)


def set_id(grams: np.ndarray) -> int:
    """A signed 64-bit name of a set: equal sets have equal names, others by chance of 2^-64."""
    total = mix(np.array([len(grams)], np.uint64) + mix(grams).sum(dtype=np.uint64))
    return int(total.view(np.int64)[0])


def head_length(n: int, percent: int) -> int:
    """So many first n-grams hold one that any partner at the threshold has among its first."""
    return n - -(-n * percent // 100) + 1


# ------------------------------------------------------------------ tables of bounded size


def _slices(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's table in compressed rows, without the parts that hold nothing."""
    for at in range(0, len(table), SLICE):
        part = table[at : at + SLICE]
        if part.any():
            raw = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([raw], pa.binary())], ["at", "part"])


def _folded(rows: DataFrame, size: int, kind: type, fold: np.ufunc) -> np.ndarray:
    """One table of ``size`` cells out of the tasks' rows ``(at, part)``; each slice is folded in
    a task, a row at a time, and the result is as large as one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for at, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                width = min(SLICE, size - at)
                part = np.frombuffer(pa.decompress(raw, width * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)
                held[at] = fold(held[at], part) if at in held else part
        for at, part in held.items():
            raw = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([raw], pa.binary())], ["at", "part"])

    out = np.zeros(size, kind)
    for at, raw in rows.repartition("at").mapInArrow(run, "at long, part binary").collect():
        width = min(SLICE, size - at)
        out[at : at + width] = np.frombuffer(pa.decompress(bytes(raw), width * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)
    return out


def _bitmap(rows: DataFrame, bits: int) -> np.ndarray:
    """Bits set for the longs of a one-column table, by their low bits: a member is always found,
    others by chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, np.uint8)
        for b in batches:
            low = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(bits - 1)
            np.bitwise_or.at(table, low >> np.uint64(3), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))
        yield from _slices(table)

    return _folded(rows.mapInArrow(run, "at long, part binary"), bits // 8, np.uint8, np.bitwise_or)


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys & np.uint64(len(bitmap) * 8 - 1)
    return bitmap[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8) & 1 > 0


def levels(counters: np.ndarray) -> np.ndarray:
    """Level of an n-gram by its sign and cell: 0 for estimates below the sketch's standard error,
    then one more each time the estimate doubles. A sixth of the rare n-grams are so taken for more
    frequent ones, which only puts them later; of frequent ones few are taken for rare."""
    error = max(2.0, 1.4826 * float(np.median(np.abs(counters))))
    out = np.zeros((2, len(counters)), np.uint8)
    for sign, row in zip((1, -1), out, strict=True):
        at = np.flatnonzero(sign * counters >= error)
        row[at] = 1 + np.log2(np.abs(counters[at]) / error)
    return out


class Order:
    """The global order of n-grams."""

    def __init__(self, counters: np.ndarray):
        self.levels = levels(counters)

    @staticmethod
    def cell(grams: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell and sign (0 or 1) of each n-gram, from bits that the hash order and the bitmaps do not lead with."""
        low = mix(grams)
        return (low & np.uint64(cells - 1)).astype(np.int64), (low >> np.uint64(63)).astype(np.int64)

    def level(self, grams: np.ndarray) -> np.ndarray:
        cell, sign = self.cell(grams, self.levels.shape[1])
        return self.levels[sign, cell]

    def arranged(self, grams: np.ndarray) -> np.ndarray:
        """Sorted hashes in the global order."""
        return grams[np.argsort(self.level(grams), kind="stable")]

    def fragments(self, grams: np.ndarray, cuts: int) -> Iterator[tuple[int, np.ndarray]]:
        """A set's non-empty pieces, cut at fixed pivots of the order: ``cuts`` hash ranges of the rare
        n-grams (level 0), then as many of the frequent ones. Each piece is sorted by hash."""
        low = self.level(grams) == 0
        pivots = [np.uint64((k << 64) // cuts) for k in range(1, cuts)]
        for first, part in ((0, grams[low]), (cuts, grams[~low])):
            for k, piece in enumerate(np.split(part, np.searchsorted(part, pivots))):
                if len(piece):
                    yield first + k, piece


def cuts_of(n: int) -> int:
    """Hash ranges for sets of this size: a power of two, so that sets of like size have like cuts."""
    return 1 << max(0, -(-n // PIECE) - 1).bit_length()


def _cuts_of(n: Column) -> Column:
    return F.when(n <= PIECE, 1).otherwise(F.pow(F.lit(2), F.length(F.bin(F.ceil(n / PIECE) - 1)))).cast("int")


# ------------------------------------------------------------------ passes over the texts


def _sets_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(name, sorted grams) of the batches' sets, without empty ones and recent copies."""
    seen: set[int] = set()
    for b in batches:
        for _, grams in shingle_sets(b.column(0), size):
            if not len(grams):
                continue
            name = set_id(grams)
            if name not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                yield name, grams


def _members(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_hash, id, n, at, part): a row for each document with its set's name and size,
    and each task's sketch in rows of their own (``at`` not null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(CELLS, np.int32)
        waiting: list[np.ndarray] = []

        def count() -> None:
            if waiting:
                cell, sign = Order.cell(np.concatenate(waiting), CELLS)
                np.add.at(counters, cell, (1 - 2 * sign).astype(np.int32))
                waiting.clear()

        held = 0
        for b in batches:
            names, sizes = [None] * b.num_rows, [0] * b.num_rows
            for row, grams in shingle_sets(b.column(2), size):
                if len(grams):
                    names[row], sizes[row] = set_id(grams), len(grams)
                    waiting.append(grams)
                    held += len(grams)
                    if held > 1 << 18:
                        count()
                        held = 0
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), none, pa.nulls(b.num_rows, pa.binary())],
                columns,
            )
        count()
        for s in _slices(counters.astype(np.int64)):
            none = pa.nulls(s.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, *s.columns], columns)

    columns = ["doc_id", "text_hash", "id", "n", "at", "part"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, id long, n long, at long, part binary")


def _long_columns(columns: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)) for a in arrays], names)


def _heads(docs: DataFrame, order: Order, size: int, percent: int) -> DataFrame:
    """(gram, id): the first n-grams of each set. Copies of a set may repeat its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], []]
        held, names = 0, ["gram", "id"]
        for name, grams in _sets_of(batches, size):
            head = order.arranged(grams)[: head_length(len(grams), percent)]
            for column, values in zip(out, (head, np.full(len(head), name)), strict=True):
                column.append(values)
            held += len(head)
            if held > 1 << 16:
                yield _long_columns(out, names)
                out, held = [[], []], 0
        yield _long_columns(out, names)

    return docs.select("text").mapInArrow(run, "gram long, id long")


def _head_lists(docs: DataFrame, order: Order, size: int, percent: int, shared: np.ndarray) -> DataFrame:
    """(id, n, grams, places): a row for each set with those of its first n-grams that the bitmap
    ``shared`` holds, if any, and their places in the set."""

    def batch(ids: list[int], sizes: list[int], heads: list[np.ndarray], places: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.cumsum([0, *map(len, heads)]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).view(np.int64))) for x in (heads, places)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["id", "n", "grams", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for name, grams in _sets_of(batches, size):
            head = order.arranged(grams)[: head_length(len(grams), percent)]
            places = np.flatnonzero(_has(shared, head))
            if not len(places):
                continue
            rows.append((name, len(grams), head[places], places))
            held += len(places)
            if held > 1 << 16:
                yield batch(*map(list, zip(*rows, strict=True)))
                rows, held = [], 0
        if rows:
            yield batch(*map(list, zip(*rows, strict=True)))

    rows = docs.select("text").mapInArrow(run, "id long, n long, grams array<long>, places array<long>")
    return rows.groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", "grams", "places")])


def _fragments(docs: DataFrame, order: Order, size: int, percent: int, wanted: np.ndarray, ways: np.ndarray) -> DataFrame:
    """(id, cuts, fragment, grams): the pieces of the sets whose text's hash the bitmap ``wanted``
    holds, once each; by the cuts of its own and of a larger partner's size, as far as the bitmap
    ``ways`` holds the name XOR the cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def kept() -> Iterator[pa.RecordBatch]:
            for b in batches:
                some = b.filter(pa.array(_has(wanted, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))))
                if some.num_rows:
                    yield some

        for name, grams in _sets_of(kept(), size):
            n = len(grams)
            some_cuts = np.array(sorted({cuts_of(n), cuts_of(-(-n * 100 // percent))}))
            for cuts in some_cuts[_has(ways, (np.int64(name) ^ some_cuts).view(np.uint64))].tolist():
                cut = list(order.fragments(grams, cuts))
                for at in range(0, len(cut), 64):
                    some = cut[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(some), pa.int64()), pa.array([cuts] * len(some), pa.int32()),
                            pa.array([k for k, _ in some], pa.int32()), pa.array([p.tobytes() for _, p in some], pa.binary()),
                        ],
                        ["id", "cuts", "fragment", "grams"],
                    )

    rows = docs.select("text", text_hash().alias("text_hash")).mapInArrow(run, "id long, cuts int, fragment int, grams binary")
    return rows.groupBy("id", "cuts", "fragment").agg(F.first("grams").alias("grams"))


# ------------------------------------------------------------------ the join


def _partial_overlaps(rows: DataFrame) -> DataFrame:
    """(a, b, overlap) of each pair and fragment: n-grams that both pieces hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [
                len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
                for x, y in zip(b.column(2), b.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64())], ["a", "b", "overlap"])

    return rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, overlap long")


class Join:
    """The links of one table at one threshold; ``pairs`` are always (a, b, na, nb)."""

    def __init__(self, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT):
        if not 50 <= percent <= 100:
            raise ValueError("percent must be 50 to 100")
        self.docs, self.size, self.percent = docs.select("doc_id", "text"), size, percent
        rows = materialise(_members(self.docs, size), "jaccard-members")
        self.members = rows.where("at is null").select("doc_id", "text_hash", "id", "n")
        self.order = Order(_folded(rows.where("at is not null").select("at", "part"), CELLS, np.int64, np.add))

    def heads(self) -> DataFrame:
        """(gram, id, n, pos): once each, the head n-grams that more than one set has in its head. They
        are kept by set for ``promising``."""
        apart = lambda rows: rows.groupBy("gram").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
        shared = _bitmap(apart(_heads(self.docs, self.order, self.size, self.percent)).select("gram"), BITS)
        self.lists = materialise(_head_lists(self.docs, self.order, self.size, self.percent, shared), "jaccard-heads")
        rows = self.lists.select("id", "n", F.inline(F.arrays_zip("grams", "places")))
        return rows.select(F.col("grams").alias("gram"), "id", "n", F.col("places").alias("pos"))

    def promising(self, pairs: DataFrame) -> DataFrame:
        """The pairs that can reach the threshold by what their heads have in common: the heads are
        prefixes of one order, so behind the one that ends first no more than the rest of its
        set is common."""
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        heads = self.lists.join(ids, "id", "left_semi")  # a row for each set
        rows = pairs.join(heads.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a")
        rows = rows.join(heads.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b")
        least = F.ceil((F.col("na") + F.col("nb")) * self.percent / (100 + self.percent))
        rest = F.ceil(F.greatest("na", "nb") * self.percent / 100) - 1
        return rows.where(F.size(F.array_intersect("x", "y")) + rest >= least).select("a", "b", "na", "nb")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """(a, b) of the distinct pairs ``(a, b, na, nb)`` at the threshold: partial overlaps summed."""
        before = materialise(pairs, "jaccard-met")
        # a pair is cut as its larger set is
        pairs = materialise(self.promising(before).withColumn("cuts", _cuts_of(F.greatest("na", "nb"))), "jaccard-pairs")
        sides = pairs.select(F.col("a").alias("id"), "cuts").unionByName(pairs.select(F.col("b").alias("id"), "cuts")).distinct()
        texts = self.members.join(sides.select("id").distinct(), "id").groupBy("id").agg(F.min("text_hash").alias("text_hash"))
        wanted = _bitmap(texts.select("text_hash"), BITS)
        ways = _bitmap(sides.select(F.col("id").bitwiseXOR(F.col("cuts").cast("long"))), BITS)
        pieces = _fragments(self.docs, self.order, self.size, self.percent, wanted, ways)
        sums = _partial_overlaps(self.met_pieces(pairs, pieces)).groupBy("a", "b").agg(F.sum("overlap").alias("overlap"))
        union = F.col("na") + F.col("nb") - F.col("overlap")
        near = pairs.join(sums, ["a", "b"]).where(F.col("overlap") * 100 >= union * self.percent)
        out = materialise(near.select("a", "b"), "jaccard-links")
        discard(pairs, before)
        return out

    @staticmethod
    def met_pieces(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
        """(a, b, x, y): the pieces of both sets of ``pairs(a, b, cuts)``, fragment by fragment. Both joins
        read one exchange of the pieces. Of a star's pairs, which share ``b``, the piece of ``b`` goes
        out to the places of the others. Pairs are many times larger by fragment than their table,
        from which Spark would choose to broadcast them, so the join is told not to."""
        wide = pairs.select("a", "b", "cuts", F.explode(F.sequence(F.lit(0), 2 * F.col("cuts") - 1)).alias("fragment"))
        two = pieces.select(F.col("id").alias("b"), "cuts", "fragment", F.col("grams").alias("y"))
        one = pieces.select(F.col("id").alias("a"), "cuts", "fragment", F.col("grams").alias("x"))
        met = wide.join(two.hint("merge"), ["b", "cuts", "fragment"]).join(one, ["a", "cuts", "fragment"])
        return met.select("a", "b", "x", "y")

    def possible(self, one: str, two: str) -> Column:
        """Whether sets whose columns end in these names can reach the threshold, if an n-gram of these
        places is the first that they have in common: none before it is in the other set."""
        n, m = F.col(f"n{one}"), F.col(f"n{two}")
        left = F.least(n - F.col(f"pos{one}"), m - F.col(f"pos{two}"))
        sizes = F.least(n, m) * 100 >= F.greatest(n, m) * self.percent
        return sizes & (left >= F.ceil((n + m) * self.percent / (100 + self.percent)))

    def stars(self, heads: DataFrame) -> DataFrame:
        """Sets of ``heads(gram, id, n, pos, c)``, each with the set of another class that leads most
        of the n-grams at which the two can be near."""
        lead = F.min(F.struct("pos", "c", "id", "n")).over(Window.partitionBy("gram"))
        rows = heads.withColumn("lead", lead).where(F.col("c") != F.col("lead.c"))
        rows = rows.select("id", "n", "pos", *[F.col(f"lead.{c}").alias(f"{c}_lead") for c in ("id", "n", "pos")])
        votes = rows.where(self.possible("", "_lead")).groupBy("id", "n", "id_lead", "n_lead").agg(F.count("*").alias("votes"))
        best = votes.groupBy("id", "n").agg(F.max(F.struct("votes", "id_lead", "n_lead")).alias("best"))
        return best.select(F.col("id").alias("a"), F.col("best.id_lead").alias("b"), F.col("n").alias("na"), F.col("best.n_lead").alias("nb"))

    def crossing(self, heads: DataFrame) -> DataFrame:
        """Pairs of sets of different classes ``c`` that meet in an n-gram of ``heads`` at which they
        can be near: of each n-gram, the sets outside its largest class with all sets of other
        classes. The first n-gram that a near pair has in common is among them."""
        by_gram = Window.partitionBy("gram")
        # dealt by n-gram once, for the windows and for both sides of the join
        rows = heads.repartition("gram").withColumn("k", F.count("*").over(Window.partitionBy("gram", "c")))
        rows = rows.withColumns({"main": F.max(F.struct("k", "c")).over(by_gram), "least": F.min("n").over(by_gram)})
        rows = rows.withColumn("minor", F.col("c") != F.col("main.c"))
        # a set whose n-gram stands so late that even the n-gram's smallest set is too large for it
        rows = rows.where((F.col("n") - F.col("pos")) * (100 + self.percent) >= (F.col("n") + F.col("least")) * self.percent)
        x = rows.where("minor").select("gram", *[F.col(c).alias(f"{c}_x") for c in ("id", "n", "pos", "c")])
        y = rows.select("gram", "minor", *[F.col(c).alias(f"{c}_y") for c in ("id", "n", "pos", "c")])
        once = ~F.col("minor") | (F.col("id_x") < F.col("id_y"))
        met = x.join(y, "gram").where((F.col("c_x") != F.col("c_y")) & once & self.possible("_x", "_y"))
        a, b = F.struct(F.col("id_x").alias("id"), F.col("n_x").alias("n")), F.struct(F.col("id_y").alias("id"), F.col("n_y").alias("n"))
        met = met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
        return met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))

    @staticmethod
    def classed(heads: DataFrame, roots: DataFrame) -> DataFrame:
        """``heads`` with the class of each set, without n-grams of one class only."""
        rows = heads.join(roots.select(F.col("node").alias("id"), F.col("root").alias("c")), "id", "left")
        rows = rows.withColumn("c", F.coalesce("c", "id"))
        by_gram = Window.partitionBy("gram")
        rows = rows.withColumns({"least": F.min("c").over(by_gram), "most": F.max("c").over(by_gram)}).where("least < most")
        return materialise(rows.drop("least", "most"), "jaccard-classed")

    def alive(self, heads: DataFrame) -> DataFrame:
        """The rows of ``heads`` at whose n-gram a near pair can first meet: those of two sets that allow
        it, or of several where the smallest is not too large for the set."""
        by_gram, one = Window.partitionBy("gram"), F.struct("n", "pos", "id")
        rows = heads.withColumns({"size": F.count("*").over(by_gram), "low": F.min(one).over(by_gram), "high": F.max(one).over(by_gram)})
        rows = rows.select(*heads.columns, "size", *[F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in ("low", "high") for c in ("n", "pos")])
        rows = rows.where((F.col("size") > 2) | ((F.col("size") == 2) & self.possible("_low", "_high")))
        fits = (F.col("n") - F.col("pos")) * (100 + self.percent) >= (F.col("n") + F.col("n_low")) * self.percent
        return materialise(rows.where(fits).select(*heads.columns), "jaccard-alive")

    def components(self) -> DataFrame:
        """(node, root): the sets that have links, with the smallest name that they reach."""
        heads = self.alive(self.heads())
        links = heads.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
        rows, before = heads.withColumn("c", F.col("id")), []  # every set is a class of its own
        for _ in range(STARS):
            pairs = materialise(self.stars(rows), "jaccard-stars")
            found = self.verified(pairs)
            links = links.unionByName(found)
            roots = materialise(connected_components(links), "jaccard-roots")
            rows = self.classed(heads, roots)
            discard(*before)
            before = [rows]
            if 2 * found.count() <= pairs.count():
                break
        links = links.unionByName(self.verified(self.crossing(rows)))
        return connected_components(links)


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text, ...)``.

    Two documents link when their sets of ``size``-word shingles have a Jaccard similarity of at
    least ``percent`` hundredths. Null and empty texts, and texts without a word, have an empty set
    and link with nothing: their component is their own doc_id. A null doc_id is kept; a component's
    id is its smallest non-null one (null if none). Repeated rows give repeated rows; extra columns
    are ignored; an empty table gives no row.
    """
    with small_batches(docs.sparkSession):
        found = Join(docs, size, percent)
        roots = found.components()
    ids = found.members.where("id is not null").groupBy("id").agg(F.min("doc_id").alias("least"))
    ids = ids.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    named = ids.join(least, "root").select("id", "component_id")
    rows = found.members.join(named, "id").select("doc_id", "n", "component_id")
    alone = found.members.where("id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return rows.unionByName(alone).withColumnRenamed("n", "n_shingles")


#: DuckDB: every pair of documents with a shingle in common, and what is reachable from each.
ORACLE = f"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE} - 1], ' '))) END AS s
  FROM worded
), grams AS MATERIALIZED (SELECT r, len(s) AS n, hash(g) AS g FROM (SELECT r, s, unnest(s) AS g FROM sets)),
links AS MATERIALIZED (
  SELECT x.r AS a, y.r AS b FROM grams x JOIN grams y ON x.g = y.g AND x.r <> y.r
  GROUP BY x.r, y.r, x.n, y.n HAVING 100 * count(*) >= {PERCENT} * (x.n + y.n - count(*))
), reach AS (SELECT r, r AS q FROM sets UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.q)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM sets s JOIN reach ON reach.r = s.r JOIN sets o ON o.r = reach.q GROUP BY s.r, s.doc_id, s.s
"""
