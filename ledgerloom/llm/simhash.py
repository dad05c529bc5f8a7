"""SimHash near-duplicate groups: generalised pigeonhole over correlated bit partitions.

1. Each text gets a 64-bit fingerprint: the majority of its shingles' XXH64 bits.
2. Equal fingerprints collapse first, so copies cost nothing afterwards.
3. The 64 x 64 bit co-occurrence counts of all fingerprints are summed; correlated bits are
   grouped into one partition, so that the partitions are close to independent.
4. With partition thresholds t_i whose sum of (t_i + 1) is d + 1, two fingerprints at
   distance <= d are within t_i in at least one partition. Dynamic programming picks the
   thresholds (-1 leaves a partition out) that minimise probes plus candidates, from the
   collisions counted over all fingerprints.
5. Probes meet equal partition values; candidates are verified on all 64 bits. A bucket of
   more than ``BUCKET`` members is linked without pairs: see ``_hub_links``.
6. Connected components over the links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.graph import connected_components
from ledgerloom.llm.shared import LOWER_TABLE, materialise, row_key, text_hash

SEED = 42
BITS = 64
#: Members up to which a bucket's candidates are verified pair by pair.
BUCKET = 24
#: Cost of verifying a candidate against that of shuffling a probe.
CANDIDATE_COST = 0.25
PIECE = 1 << 22
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(raw):
        stop = len(raw)
        if stop - at > PIECE and (gap := _GAP.search(raw, at + PIECE)):
            stop = gap.start()
        yield raw[at:stop].split()
        at = stop


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text, unsigned. No word: 0; fewer words than a
    shingle: the whole sequence is the one shingle. A bit is set if over half have it."""
    counts, total, carry = np.zeros(BITS, np.int64), 0, []
    raw = raw.translate(LOWER_TABLE)
    for words in _pieces(raw):
        words = carry + words
        if len(words) >= shingle:
            runs = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
            n = len(words) - shingle + 1
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, n)
            for at in range(0, n, 1 << 16):
                part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += n
            words = words[n:]
        carry = words
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): one row per row of docs; fp is the fingerprint's bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in b.column(2)]
            fp = np.array(bits, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def bit_moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are and, for each two bits, how many have both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for b in batches:
            raw = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint8).reshape(-1, 8)
            for at in range(0, len(raw), 1 << 14):
                x = np.unpackbits(raw[at : at + (1 << 14)], axis=1, bitorder="little").astype(np.float32)
                both += (x.T @ x).astype(np.int64)
            n += len(raw)
        i, j = np.triu_indices(BITS)
        # cell (0, -1) carries the number of rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, 0)), pa.array(np.append(j, -1)), pa.array(np.append(both[i, j], n))], ["i", "j", "n"]
        )

    out, total = np.zeros((BITS, BITS)), 0
    cells = fps.mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    for i, j, n in cells.collect():  # 64 * 65 / 2 + 1 rows at most
        if j < 0:
            total = n
        else:
            out[i, j] = out[j, i] = n
    return total, out


def group_bits(total: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of near-equal size. A group starts with the free bit of
    the strongest correlation and takes the free bit that is most correlated with it."""
    p = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    rho = np.abs((both / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(rho, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = (BITS - sum(map(len, groups))) // (parts - k)
        inner = rho[np.ix_(free, free)]
        group = [free.pop(int(inner.max(axis=1).argmax()))]
        while len(group) < width:
            pull = rho[np.ix_(free, group)].sum(axis=1)
            group.append(free.pop(int(pull.argmax())))
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum(t_i + 1) = distance + 1 of least total cost.
    ``costs[i][t + 1]`` is the cost of threshold t in partition i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for units, more in enumerate(row[: distance + 2 - used]):
                now = (cost + more, [*chosen, units - 1])
                if used + units not in step or now[0] < step[used + units][0]:
                    step[used + units] = now
        best = step
    return best[distance + 1]


def _as_long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(bits: list[int]) -> int:
    return _as_long(sum(1 << b for b in bits))


def _balls(bits: list[int], radius: int) -> list[int]:
    """What to xor with, to reach every value within radius in the given bits."""
    return [_mask(list(c)) for r in range(radius + 1) for c in combinations(bits, r)]


def _within(p: np.ndarray, limit: int) -> np.ndarray:
    """Probability that two values differ in 0, 1 .. limit bits, given each bit's frequency."""
    out = np.zeros(limit + 1)
    out[0] = 1.0
    for q in 2 * p * (1 - p):
        out[1:] = out[1:] * (1 - q) + out[:-1] * q
        out[0] *= 1 - q
    return out


def plan(fps: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)]: the cheapest of the partitionings into 2 .. distance + 2 parts."""
    total, both = bit_moments(fps)
    if not total:
        return []
    p = np.diag(both) / total
    options = [group_bits(total, both, m) for m in range(2, distance + 3)]
    flat = [(o, i, bits) for o, groups in enumerate(options) for i, bits in enumerate(groups)]
    keys = F.array(
        *(F.struct(F.lit(o).alias("o"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_mask(b))).alias("key")) for o, i, b in flat)
    )
    met = (
        fps.select(F.explode(keys).alias("k"))
        .select("k.*")
        .groupBy("o", "i", "key")
        .agg(F.count("*").alias("n"))
        .groupBy("o", "i")
        .agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    )
    equal = {(r["o"], r["i"]): r["pairs"] for r in met.collect()}  # a row per partition
    best = None
    for o, groups in enumerate(options):
        costs = []
        for i, bits in enumerate(groups):
            near = _within(p[bits], distance)
            pairs = max(equal.get((o, i), 0.0), total * total / 2 * near[0])
            row = [0.0]
            for t in range(distance + 1):
                probes = total * len(_balls(bits, t))
                row.append(probes + CANDIDATE_COST * pairs * near[: t + 1].sum() / max(near[0], 1e-12))
            costs.append(row)
        cost, thresholds = allocate(costs, distance)
        if best is None or cost < best[0]:
            best = (cost, list(zip(groups, thresholds, strict=True)))
    return best[1]


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(v).cast("long") for v in values))


def _probes(fps: DataFrame, chosen: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp, own): the value of each partition in use, and those within its threshold."""
    out = None
    for i, (bits, t) in enumerate(chosen):
        if t < 0:
            continue
        value = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
        keys = F.explode(F.transform(_longs(_balls(bits, t)), lambda m, v=value: v.bitwiseXOR(m))) if t else value
        rows = fps.select(F.lit(i).alias("part"), "fp", value.alias("value"), keys.alias("key"))
        rows = rows.select("part", "key", "fp", (F.col("key") == F.col("value")).alias("own"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _pair_links(members: DataFrame, distance: int) -> DataFrame:
    """Verified pairs of buckets that hold at most BUCKET members."""
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= distance
    groups = members.groupBy("part", "key").agg(F.collect_list(F.struct("fp", "own")).alias("g"))
    first = groups.select("g", F.explode("g").alias("x")).where("x.own")
    second = first.select(
        F.col("x.fp").alias("a"), F.explode(F.filter("g", lambda y: near(y["fp"], F.col("x.fp")))).alias("y")
    )
    return second.select("a", F.col("y.fp").alias("b"))


def _hub_links(members: DataFrame, distance: int) -> DataFrame:
    """Links between the members of large buckets, without their pairs.

    f and g are within d = 2k of each other if and only if some value is within k of both;
    within 2k + 1 if some value is within k of one and k + 1 of the other. Each member
    visits the values around it; the visitors of a value are linked to its smallest visitor
    within k. A value has no more visitors than there are values around it, so no group is
    large, and the rows are linear in the members.
    """
    k = distance // 2
    near = _balls(list(range(BITS)), k)
    far = _balls(list(range(BITS)), k + 1)[len(near) :] if distance % 2 else []
    members = members.select("fp").distinct()
    visits = members.select("fp", F.explode(F.transform(_longs(near), lambda m: F.col("fp").bitwiseXOR(m))).alias("at"), F.lit(True).alias("near"))
    if far:
        visits = visits.unionByName(
            members.select("fp", F.explode(F.transform(_longs(far), lambda m: F.col("fp").bitwiseXOR(m))).alias("at"), F.lit(False).alias("near"))
        )
    met = visits.groupBy("at").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("a"), F.collect_set("fp").alias("g"))
    return met.where("a is not null and size(g) > 1").select("a", F.explode("g").alias("b"))


def links(fps: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fps(fp)``, complete up to connectivity:
    two fingerprints at ``distance`` or less are connected, and no other edge exists."""
    if not 0 <= distance <= 4:
        raise ValueError("distance must be 0 to 4")
    chosen = plan(fps, distance)
    if not chosen or not distance:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    rows = _probes(fps, chosen)
    sizes = rows.groupBy("part", "key").agg(F.count("*").alias("n"), F.max("own").alias("any_own")).where("n > 1 and any_own")
    met = rows.join(sizes, ["part", "key"])
    pairs = _pair_links(met.where(F.col("n") <= bucket), distance)
    return pairs.unionByName(_hub_links(met.where(F.col("n") > bucket), distance)).where("a <> b")


def group(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, text_hash, fp, root): one row per row of docs; rows with one root are linked."""
    fps = materialise(fingerprints(docs, shingle), "fingerprints")
    found = connected_components(links(fps.select("fp").distinct(), distance))
    return fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "doc_id", "text_hash", "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text, ...)``.

    Null and empty texts and texts without a word have fingerprint 0 and are linked like any
    other. A null doc_id is kept; the component's id is the smallest non-null one (null if
    none). Repeated rows give repeated rows. Other columns are ignored. An empty table gives
    no row.
    """
    rows = materialise(group(docs, shingle, distance), "groups")
    ids = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(ids, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id (nulls last), among rows of
    that id the smallest text hash, and one of equal rows."""
    rows = group(docs, shingle, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    keep = rows.groupBy("root").agg(first).select(row_key(F.col("first.doc_id"), F.col("first.text_hash")).alias("_row")).distinct()
    kept = docs.withColumn("_row", row_key(F.col("doc_id").cast("long"), text_hash())).join(keep, "_row", "left_semi")
    return kept.dropDuplicates(["_row"]).select(*docs.columns)
