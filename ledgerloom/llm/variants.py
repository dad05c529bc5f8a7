"""Spelling variants: the vocabulary's acceptor composed with a one-edit transducer and itself.

1. One pass counts the words of whole texts (partial counts a task, summed by a shuffle).
2. Two words of at least 7 code points, one edit apart, have their first k or their last k code
   points in common, with k the smaller half of the shorter one. Each word goes to the partitions
   of its first and of its last code points (there it is read backwards): those are the states
   that the vocabulary's acceptor reaches from its initial state without an edit.
3. In each partition the words are made a minimal acceptor A, and A . T . A is walked, T being
   the transducer of exactly one insertion, deletion or replacement. Without an edit both sides
   are in one state, so a walk over A's states finds all edits; after it the two sides read the
   same rest, and what they accept in common is known for each pair of states.
4. A partition of more than ``GROUP`` words is split by its own first move: edits at its first
   code point meet by what is left without that code point (an alphabet's worth of words), the
   others meet again in the partitions one code point deeper.
5. A word's form is its most frequent near word; chains of forms are followed to their end.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import LOWER_TABLE, discard, materialise

# --- fixed values of the contract ---
LEAST_LENGTH, LEAST_COUNT, DROP_MOD, FORM_RATIO = 7, 2, 31, 10
LETTERS = "A-Za-zÀ-ÿ"
# --- end of fixed values ---
#: Words of one partition that are walked in one task.
GROUP = 20_000
#: Words that a task holds at a time, a partition's words always together.
CHUNK = 4096
PIECE = 1 << 22
_RUN = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")
_GAP = re.compile(f"[^{LETTERS}]")


# ------------------------------------------------------------------ words


def _runs(text: str) -> Iterator[list[str]]:
    at = 0
    while at < len(text):
        stop = len(text)
        if stop - at > PIECE and (gap := _GAP.search(text, at + PIECE)):
            stop = gap.start()
        yield _RUN.findall(text, at, stop)
        at = stop


def altered(doc_id: str, run: str) -> str:
    """The run as it counts in this document: without one code point where 31 divides the hash."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DROP_MOD:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(doc_id: str, text: bytes, into: Counter) -> None:
    """Add the text's words of at least 7 code points (runs shorter than that cannot become one)."""
    for found in _runs(text.translate(LOWER_TABLE).decode()):
        for run, n in Counter(found).items():
            word = altered(doc_id, run)
            if len(word) >= LEAST_LENGTH:
                into[word] += n


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least 7 code points and how often they occur, ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if text.is_valid:
                    count_words(doc_id, text.as_buffer().to_pybytes(), counts)
                if len(counts) > 1 << 18:
                    yield _counts(counts)
                    counts.clear()
        yield _counts(counts)

    def _counts(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ------------------------------------------------------------------ automata


class Acceptor:
    """The minimal acyclic acceptor of words given in order: equal states are one, so a state is
    known by what it accepts."""

    def __init__(self, words: Iterable[str]):
        self.moves: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        # the states along the last word that may still change, as (symbol to the next, moves, final)
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]
        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path += [({}, [False]) for _ in range(len(word) - same)]
            path[-1][1][0] = True
            last = word
        self._close(path, last, 0)
        self.start = self._state(*path[0])

    def _state(self, moves: dict[str, int], final: list[bool]) -> int:
        key = (final[0], *sorted(moves.items()))
        if key not in self.known:
            self.known[key] = len(self.moves)
            self.moves.append(moves)
            self.final.append(final[0])
        return self.known[key]

    def _close(self, path: list, last: str, keep: int) -> None:
        """Settle the states below the first ``keep`` symbols of the last word."""
        while len(path) > keep + 1:
            state = self._state(*path.pop())
            path[-1][0][last[len(path) - 1]] = state


def _spelled(read: tuple) -> str:
    """The symbols of a path, which is (the path before, its last symbol): long words share theirs."""
    out = []
    while read:
        read, c = read
        out.append(c)
    return "".join(reversed(out))


class Composition:
    """Pairs accepted by A . T . A, where T makes exactly one edit."""

    def __init__(self, acceptor: Acceptor):
        self.a = acceptor
        self.met: dict[tuple[int, int], bool] = {}

    def meet(self, p: int, q: int) -> bool:
        """Whether the two states accept a word in common."""
        if p == q:
            return True
        stack = [(p, q)]
        while stack:
            pair = stack[-1]
            if pair in self.met:
                stack.pop()
                continue
            u, v = pair
            if u == v or (self.a.final[u] and self.a.final[v]):
                self.met[pair] = True
                continue
            one, two = self.a.moves[u], self.a.moves[v]
            below = [(one[c], two[c]) for c in one.keys() & two.keys()]
            if any(self.met.get(x, x[0] == x[1]) for x in below):
                self.met[pair] = True
            elif open_ := [x for x in below if x not in self.met]:
                stack.extend(open_)
            else:
                self.met[pair] = False
        return self.met[p, q]

    def rests(self, p: int, q: int) -> Iterator[str]:
        """The words that both states accept."""
        stack: list[tuple[int, int, tuple]] = [(p, q, ())]
        while stack:
            u, v, read = stack.pop()
            if self.a.final[u] and self.a.final[v]:
                yield _spelled(read)
            one, two = self.a.moves[u], self.a.moves[v]
            stack.extend((one[c], two[c], (read, c)) for c in one.keys() & two.keys() if self.meet(one[c], two[c]))

    def edits(self, p: int) -> list[tuple[str, str, int, int]]:
        """The transducer's edit moves from state p on both sides, as (left symbol, right symbol,
        left state, right state) that still accept something; each unordered pair once."""
        moves = sorted(self.a.moves[p].items())
        out = [(c, d, x, y) for i, (c, x) in enumerate(moves) for d, y in moves[i + 1 :] if self.meet(x, y)]
        return out + [(c, "", x, p) for c, x in moves if self.meet(x, p)]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All accepted pairs, each unordered pair once."""
        known: dict[int, list[tuple[str, str, int, int]]] = {}
        stack: list[tuple[int, tuple]] = [(self.a.start, ())]
        while stack:
            p, read = stack.pop()
            if p not in known:
                known[p] = self.edits(p)
            for c, d, x, y in known[p]:
                before = _spelled(read)
                for rest in self.rests(x, y):
                    # of equal code points in a row the last one counts as the deleted one
                    if d or not rest.startswith(c):
                        yield before + c + rest, before + d + rest
            stack.extend((q, (read, c)) for c, q in self.a.moves[p].items())


def near_pairs(words: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Unordered pairs of the given distinct words that differ by one edit, each once."""
    return Composition(Acceptor(sorted(words))).pairs()


# ------------------------------------------------------------------ partitions


def _halves(word: Column) -> Column:
    """The k of the pairs that a word is in: as the shorter one (or of equal length), and as the longer."""
    size = F.length(word)
    return F.array_distinct(F.array(F.floor((size - 1) / 2).cast("int"), F.floor((size - 2) / 2).cast("int")))


def _dealt(words: DataFrame) -> DataFrame:
    """(back, k, depth, part, w, n): each word, read forwards and backwards, in its partitions."""
    sides = F.array(F.struct(F.lit(False).alias("back"), F.col("word").alias("w")), F.struct(F.lit(True).alias("back"), F.reverse("word").alias("w")))
    rows = words.select("n", F.explode(sides).alias("s"), _halves(F.col("word")).alias("ks"))
    rows = rows.select("n", "s.back", "s.w", F.explode("ks").alias("k"))
    return rows.select("back", "k", F.col("k").alias("depth"), F.substring("w", F.lit(1), F.col("k")).alias("part"), "w", "n")


def _wanted(a: str, b: str, k: int, back: bool) -> bool:
    """Whether this partition reports the pair: its k is the shorter word's, and only one that
    shares no first half is left to the partitions of last halves."""
    short = min(len(a), len(b))
    return (short - 1) // 2 == k and not (back and a[::-1][:k] == b[::-1][:k])


_NEAR = "word string, near string, near_n long"


def _batch(found: list[tuple[str, str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.int64())],
        ["word", "near", "near_n"],
    )


def _both_ways(a: str, b: str, n: dict[str, int], back: bool) -> list[tuple[str, str, int]]:
    u, v = (a[::-1], b[::-1]) if back else (a, b)
    return [(u, v, n[b]), (v, u, n[a])]


def _walk(groups: list[tuple[tuple, dict[str, int]]]) -> Iterator[pa.RecordBatch]:
    """Near pairs of some partitions, by one acceptor for each."""
    found = []
    for (back, k), words in groups:
        for a, b in near_pairs(words):
            if _wanted(a, b, k, back):
                found += _both_ways(a, b, words, back)
                if len(found) >= 1 << 16:
                    yield _batch(found)
                    found = []
    yield _batch(found)


def _walk_partitions(rows: DataFrame) -> DataFrame:
    """Near pairs within partitions of bounded size."""
    keys = ["back", "k", "depth", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, groups, held = None, {}, [], 0
        for b in batches:
            for back, k, depth, part, w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (back, k, depth, part) != at:
                    if len(words) > 1:
                        groups.append((at[:2], words))
                        held += len(words)
                    if held >= CHUNK:
                        yield from _walk(groups)
                        groups, held = [], 0
                    at, words = (back, k, depth, part), {}
                words[w] = n
        if len(words) > 1:
            groups.append((at[:2], words))
        yield from _walk(groups)

    return rows.select(*keys, "w", "n").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _NEAR)


def _edits_here(rows: DataFrame) -> DataFrame:
    """Near pairs of partitions whose edit is at the first code point after the shared ones: the
    words meet by what they are without it. A meeting has as many words as there are letters."""
    gone = F.concat("part", F.substring("w", F.col("depth") + 2, F.length("w")))
    keys = ["back", "k", "depth", "rest"]
    less = rows.where(F.length("w") > F.col("depth")).select("back", "k", "depth", gone.alias("rest"), "w", "n")
    both = less.unionByName(rows.select("back", "k", "depth", F.col("w").alias("rest"), "w", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words = None, {}
        for b in batches:
            found = []
            for back, k, depth, rest, w, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (back, k, depth, rest) != at:
                    at, words = (back, k, depth, rest), {}
                if w in words:
                    continue
                for v in words:
                    x, y = sorted((w, v), key=len)
                    # one edit, and the first difference is here: a later one belongs to a deeper partition
                    here = x[depth : depth + 1] != y[depth : depth + 1]
                    one = len(x) == len(y) or x == rest
                    if here and one and abs(len(x) - len(y)) <= 1 and _wanted(x, y, k, back):
                        found += _both_ways(x, y, {w: n, v: words[v]}, back)
                words[w] = n
            yield _batch(found)

    return both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _NEAR)


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, near, near_n) for every ordered pair of near words of ``words(word, n)``, the words
    distinct and of at least 3 code points."""
    keys = ["back", "k", "depth", "part"]
    rows, out = _dealt(words), None
    while True:
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1")
        large = materialise(sizes.where(F.col("size") > group).select(*keys), "variants-large")
        hot = not large.isEmpty()
        here = rows.join(large, keys, "left_anti") if hot else rows
        found = _walk_partitions(here)
        out = found if out is None else out.unionByName(found)
        if not hot:
            return out
        rows = materialise(rows.join(large, keys, "left_semi"), "variants-rows")
        out = out.unionByName(_edits_here(rows))
        deeper = F.col("depth") + 1
        rows = rows.where(F.length("w") > F.col("depth")).select(
            "back", "k", deeper.alias("depth"), F.substring("w", F.lit(1), deeper).alias("part"), "w", "n"
        )


# ------------------------------------------------------------------ forms


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) for ``links(word, form)``: forms followed to their end by pointer doubling. A
    form is 10 times as frequent as its word, so chains end and the rounds are few."""
    now = materialise(links.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = now.join(onward, "root", "left")
        if step.where("onward is not null").isEmpty():
            return now
        before, now = now, materialise(step.select("word", F.coalesce("onward", "root").alias("root")), "variants-roots")
        discard(before)


def variants(docs: DataFrame, least: int = LEAST_COUNT, ratio: int = FORM_RATIO, group: int = GROUP) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``docs(doc_id, text, ...)`` that
    occurs at least ``least`` times.

    Null and empty texts have no word; a null doc_id counts as an empty string where the hash takes
    it. Repeated rows count again. Of near words equally frequent the smallest in code-point order
    is the form. Extra columns are ignored; an empty table gives no row.
    """
    words = materialise(vocabulary(docs, least), "variants-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words, group).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(near, "word", "left")
    enough = -F.col("best.less") >= F.col("n") * ratio
    rows = materialise(
        rows.select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "variants-forms",
    )
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
