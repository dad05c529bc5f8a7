"""Exact nearest neighbours by inner product, in tiles of queries and vectors.

Vectors that are equal collapse into one node first. Every query is held against every node:
a pass takes as many queries as fit QUERY_CELLS numbers to all tasks, and each task multiplies
tiles of them with tiles of its nodes, keeps the best of each query seen so far and returns
those. Matrix products only tell which pairs can be among the best, up to a bound of their
rounding; what counts are scores summed in one fixed order, so the result does not depend on
how the nodes are dealt. The work grows with queries times nodes, what is returned with queries
times tasks; no group of similar vectors is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.shared import materialise

TOP = 20
#: Queries of a pass, at most, and numbers of their vectors (8 bytes each in every task).
QUERY_BLOCK = 1 << 16
QUERY_CELLS = 1 << 22
#: Queries and nodes of a tile.
TILE = (512, 4096)
#: Numbers of the vectors of pairs that are scored at a time.
PAIR_CELLS = 1 << 21


def usable(rows: DataFrame) -> DataFrame:
    """Rows ``(vec_id, vec)`` whose id and vector are given, not zero and finite throughout."""
    vec = F.col("vec")
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))
    return rows.where(vec.isNotNull() & F.col("vec_id").isNotNull()).where(F.forall(vec, fine) & F.exists(vec, lambda v: v != 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), flat.dtype)


def _scores(x: np.ndarray, y: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Inner products of x[at] and y[to], each summed from the first component to the last."""
    out, step = np.zeros(len(at)), max(1, PAIR_CELLS // x.shape[1])
    for lo in range(0, len(at), step):
        some = slice(lo, lo + step)
        out[some] = np.cumsum(x[at[some]] * y[to[some]], axis=1)[:, -1] + 0.0  # no negative zero
    return out


class _Best:
    """The ``top`` best nodes of each query among those added; ties to the smaller id."""

    def __init__(self, queries: np.ndarray, top: int):
        self.queries, self.top = queries, top
        self.lengths = np.sqrt((queries**2).sum(axis=1))
        self.score = np.full((len(queries), top), -np.inf)
        self.id = np.full((len(queries), top), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, vecs: np.ndarray) -> None:
        longest = np.sqrt((vecs**2).sum(axis=1).max())
        for lo in range(0, len(self.queries), TILE[0]):
            x = self.queries[lo : lo + TILE[0]]
            products = x @ vecs.T
            # what two ways of summing can differ by, and twice that between two pairs
            slack = 8 * x.shape[1] * 2.0**-53 * longest * self.lengths[lo : lo + TILE[0]]
            floor = self.score[lo : lo + TILE[0], -1] - slack
            many = np.flatnonzero((products >= floor[:, None]).sum(axis=1) > self.top)
            if len(many):
                edge = np.partition(products[many], -self.top, axis=1)[:, -self.top]
                floor[many] = np.maximum(floor[many], edge - slack[many])
            at, to = np.nonzero(products >= floor[:, None])
            if len(at):
                self._merge(lo + at, ids[to], _scores(self.queries, vecs, lo + at, to))

    def _merge(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        held = np.unique(at)
        at = np.concatenate([at, np.repeat(held, self.top)])
        ids = np.concatenate([ids, self.id[held].ravel()])
        scores = np.concatenate([scores, self.score[held].ravel()])
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < self.top
        self.score[at[kept], place[kept]] = scores[kept]
        self.id[at[kept], place[kept]] = ids[kept]


def brute_force(nodes: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """``(q, v, score)``: for each node q of ``queries(q)`` the ``top`` nodes of ``nodes(id, vec)``
    with the largest inner products (itself may be one), ties to the smaller id. A pass of
    queries at a time is held in the driver and sent to all tasks."""
    vecs = nodes.select("id", "vec")
    asked = materialise(queries.join(vecs, queries["q"] == vecs["id"]).select("q", "vec"), "asked")
    count, length = asked.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not count:
        return asked.select("q", F.col("q").alias("v"), F.lit(0.0).alias("score")).limit(0)
    passes = -(-count // max(1, min(QUERY_BLOCK, QUERY_CELLS // length)))
    order = W.partitionBy("q").orderBy(F.desc("score"), "v")
    out = None
    for b in range(passes):
        part = asked.where(F.pmod(F.xxhash64("q"), F.lit(passes)) == b).toArrow().combine_chunks()
        if not part.num_rows:
            continue
        held = part.column("q").combine_chunks().to_numpy(), _matrix(part.column("vec").combine_chunks())
        sent = nodes.sparkSession.sparkContext.broadcast(held)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, matrix = sent.value
            best = None
            for batch in batches:
                for lo in range(0, batch.num_rows, TILE[1]):
                    best = best or _Best(matrix.astype(np.float64), top)
                    some = batch.slice(lo, TILE[1])
                    best.add(some.column(0).to_numpy(), _matrix(some.column(1)).astype(np.float64))
            for lo in range(0, len(ids) if best else 0, TILE[1]):
                at, place = np.nonzero(best.score[lo : lo + TILE[1]] > -np.inf)
                cols = [ids[lo + at], best.id[lo + at, place], best.score[lo + at, place]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["q", "v", "score"])

        found = vecs.mapInArrow(run, "q long, v long, score double")
        found = materialise(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top).drop("r"), "found")
        sent.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def nearest(rows: DataFrame, asks: Column, top: int = TOP) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``rows(vec_id, vec, ...)`` that
    satisfies ``asks``, the ``top`` nearest other rows (all, if there are fewer).

    Score: the inner product of the original vectors in double precision, summed from the first
    component to the last; ties go to the smaller vec_id. Vectors that are null, zero or hold
    nulls or non-finite components take no part, nor do rows without an id; rows equal in id and
    vector count once, an id with several vectors is several rows, none of which is another's
    neighbour. Vectors taking part that differ in length raise a ValueError. Other columns are
    ignored; no row gives no row.

    A vector that many rows share is one node: its ``top + 1`` smallest ids stand for it, which
    are enough for every query.
    """
    rows = materialise(usable(rows).select("vec_id", "vec", asks.alias("asks")).distinct(), "vectors")
    nodes = materialise(rows.groupBy("vec").agg(F.min("vec_id").alias("id")), "nodes")
    if nodes.isEmpty():
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    lengths = sorted(r[0] for r in nodes.select(F.size("vec")).distinct().limit(2).collect())
    if len(lengths) > 1:
        raise ValueError(f"vectors of unequal length: {lengths[0]} and {lengths[1]} components")
    known = materialise(rows.join(nodes, "vec").select("vec_id", "asks", "id"), "members")
    queries = known.where("asks").select(F.col("id").alias("q")).distinct()
    found = brute_force(nodes, queries, top + 1)
    order = W.partitionBy("id").orderBy("vec_id")
    first = known.select("id", "vec_id").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= top + 1).drop("r")
    near = found.join(first, F.col("v") == F.col("id")).select("q", "vec_id", "score")
    best = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top + 1)
    lists = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    asked = known.where("asks").select(F.col("vec_id").alias("query_id"), F.col("id").alias("q"))
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, top)
    out = asked.join(materialise(lists, "near"), "q").select("query_id", F.posexplode(own).alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


#: DuckDB: every query against every vector, each product summed from the first component on.
ORACLE = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda c: isfinite(c)))
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), near AS (
  SELECT q.vec_id AS query_id, v.vec_id, 0.0::DOUBLE + list_reduce(
    list_transform(range(1, len(v.v) + 1), lambda i: q.v[i] * v.v[i]), lambda a, b: a + b) AS score, q.v AS q
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM near QUALIFY rank <= {TOP}
"""
