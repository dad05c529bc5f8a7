"""Time-varying curriculum: integrate weight schedules, invert cumulative demand, sort by position.

A source's schedule is a piecewise linear weight over training time 0..1. Its integral is the
source's weight; the weights give the sources' target words. Walking through a source's
documents in a fixed random order, the words before a copy are its cumulative demand; the time
at which the schedule has demanded that many words is the copy's training position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.shared import WORD_REGEX, materialise, row_key

#: Knots (time, weight), given to the sources in turn; their integrals are 3, 1 and 2.
SCHEDULES = (((0.0, 1.5), (1.0, 4.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 3.0), (1.0, 1.0)))
SHARE = 1.5
MOST = 2
#: Hex digits of a document's hash that make its bucket: a source is split into 16 ** DIGITS.
DIGITS = 3


def _text_md5() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def area(knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))


def _check(schedules) -> None:
    for knots in schedules:
        times = [t for t, _ in knots]
        if times[0] != 0 or times[-1] != 1 or sorted(set(times)) != times or min(w for _, w in knots) < 0 or area(knots) <= 0:
            raise ValueError("a schedule goes from time 0 to 1 in growing steps, with weights of at least 0 and not all 0")


def when_reached(knots, share: Column) -> Column:
    """The time at which the schedule's integral is ``share`` of the whole: each linear piece
    has a quadratic integral, inverted in closed form."""
    r = share * area(knots)
    out, before = F.lit(None).cast("double"), []
    done = 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        rest = r - done
        root = F.sqrt(F.lit(w0 * w0) + 2 * (w1 - w0) / (t1 - t0) * rest)
        at = t0 + F.when(rest <= 0, 0.0).otherwise(2 * rest / (w0 + root))
        done += (t1 - t0) * (w0 + w1) / 2
        before.append((r <= done, F.least(at, F.lit(t1))))
    out = F.lit(1.0)
    for test, value in reversed(before):
        out = F.when(test, value).otherwise(out)
    return out


def targets(sizes: DataFrame, schedules=SCHEDULES, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(src, source_size, target, turn)`` for ``sizes(src, source_size)``, a row per source.

    Weights are the schedules' integrals, given to the sources in order. A target that would
    be above ``most`` times its source's size stops there and the excess goes to the others by
    weight: in the order of size over weight, a source is stopped if what is left to share
    reaches its limit. The windows run over one row per source.
    """
    weight = F.element_at(F.array(*(F.lit(area(k)) for k in schedules)), (F.col("turn") + 1).cast("int"))
    ranked = sizes.withColumn("turn", (F.row_number().over(W.orderBy("src")) - 1) % len(schedules)).withColumn("weight", weight)
    limit = F.col("source_size") * float(most)
    order = W.orderBy(F.col("source_size") / F.col("weight"), "src")
    whole = W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    total = share * F.sum("source_size").over(whole)
    left = total - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    seen = ranked.withColumn("limit", limit).withColumn("total", total).withColumn("stop", limit * weights <= left * F.col("weight"))
    stopped = F.coalesce(F.sum(F.when(F.col("stop"), F.col("limit"))).over(whole), F.lit(0.0))
    sharing = F.sum(F.when(~F.col("stop"), F.col("weight"))).over(whole)
    target = F.when(F.col("stop"), F.col("limit")).otherwise(F.col("weight") * (F.col("total") - stopped) / sharing)
    return seen.select("src", "source_size", target.alias("target"), "turn")


def plan(docs: DataFrame, schedules=SCHEDULES, share: float = SHARE, most: int = MOST) -> DataFrame:
    """A row per row of ``docs(doc_id, text, source, ...)``: ``doc_id, text_md5, size,
    source_size, target, taken, before, turn``.

    ``before``: the source's words that come earlier in its order, which is that of
    md5(doc_id), doc_id and md5(text) (nulls as empty strings; equal rows in any order).
    Copy e of a document covers the words from e * source_size + before on; ``taken`` is what
    of all copies lies before the target (rounded down), so a document at the end may be taken
    in part and a source's sum is exact. Size 0 takes none. A null source is one, last in order.
    Empty table: no row.

    A hot source is split into buckets by hash: words are summed per bucket, prefix sums run
    over buckets, then within each bucket.
    """
    _check(schedules)
    src = F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1"))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_REGEX)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", src.alias("src"), size.alias("size"), key.alias("key"), _text_md5().alias("text_md5"))
    rows = materialise(rows.withColumn("bucket", F.substring("key", 1, DIGITS)), "mix")
    by_bucket = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("src").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = by_bucket.select("src", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    wanted = targets(rows.groupBy("src").agg(F.sum("size").alias("source_size")), schedules, share, most)
    inner = W.partitionBy("src", "bucket").orderBy("key", "doc_id", "text_md5").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.join(buckets, ["src", "bucket"]).withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    end = F.floor("target")
    copies = [F.greatest(F.lit(0), F.least("size", end - e * F.col("source_size") - F.col("before"))) for e in range(most)]
    return placed.join(wanted, "src").select(
        "doc_id", "text_md5", "size", "source_size", "target", sum(copies).cast("long").alias("taken"), "before", "turn"
    )


def _position(turn: Column, share: Column, schedules) -> Column:
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        out = F.when(turn == k, when_reached(knots, share)).otherwise(out)
    return out


def positions(planned: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """``plan``'s rows with ``position``, the time of the first copy (null if none is taken)."""
    share = F.col("before") / F.col("target")
    at = _position(F.col("turn"), share, schedules)
    return planned.withColumn("position", F.when(F.col("taken") > 0, at))


def in_order(rows: DataFrame, *ties: str) -> DataFrame:
    """``rows`` range-sorted by position, those without one last; ties by the given columns."""
    by = [F.col("position").asc_nulls_last(), *(F.col(c).asc() for c in ties)]
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def mix(docs: DataFrame, schedules=SCHEDULES, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The training sequence: ``docs``' columns, ``epoch``, ``words`` (of the text's, counted
    from its start) and ``position``, a row for each copy taken, range-sorted by position.

    Columns of docs named like the three new ones are replaced. Rows equal in doc_id and text
    are one document that occurs as often; its further columns are those of one of the rows.
    Nulls and ties: see ``plan``. Ties in position go by doc_id, then epoch.
    """
    planned = plan(docs, schedules, share, most).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    start = F.col("epoch") * F.col("source_size") + F.col("before")
    words = F.greatest(F.lit(0), F.least("size", F.floor("target") - start)).cast("long")
    at = _position(F.col("turn"), start / F.col("target"), schedules)
    rows = planned.select(row_key(F.col("doc_id"), F.col("text_md5")).alias("_row"), "epoch", words.alias("words"), at.alias("position")).where("words > 0")
    names = [c for c in docs.columns if c not in ("epoch", "words", "position")]
    own = docs.select(*names, row_key(F.col("doc_id"), _text_md5()).alias("_row")).dropDuplicates(["_row"])
    return in_order(own.join(rows, "_row").select(*names, "epoch", "words", "position"), "doc_id", "epoch")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key, md5(coalesce(text, '')) AS text_md5
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn
  FROM d GROUP BY source
), w AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][turn + 1] AS weight, [1.5::DOUBLE, 1.0::DOUBLE, 3.0::DOUBLE][turn + 1] AS w0,
         [4.5::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE][turn + 1] AS w1 FROM s
), level AS (  -- the common words per unit of weight: above it a source is stopped at twice its size
  SELECT max(CASE WHEN 2 * a.n > lam * a.weight THEN lam END) AS water FROM (
    SELECT x.*, (1.5 * (SELECT sum(n) FROM w) - coalesce((SELECT sum(2 * y.n) FROM w y WHERE y.n / y.weight < x.n / x.weight), 0))
             / (SELECT sum(y.weight) FROM w y WHERE y.n / y.weight >= x.n / x.weight) AS lam FROM w x) a
), t AS (
  SELECT w.*, 2 * n <= water * weight OR water IS NULL AS stop FROM w, level
), u AS (
  SELECT *, CASE WHEN stop THEN 2 * n ELSE
    weight * (1.5 * sum(n) OVER () - coalesce(sum(CASE WHEN stop THEN 2 * n END) OVER (), 0))
    / sum(CASE WHEN NOT stop THEN weight END) OVER () END AS target
  FROM t
), p AS (
  SELECT doc_id, size, CAST(n AS BIGINT) AS source_size, target, w0, w1, weight,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, text_md5
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
), q AS (
  SELECT *, greatest(0, least(size, floor(target) - before)) + greatest(0, least(size, floor(target) - source_size - before)) AS taken
  FROM p
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN CASE WHEN before = 0 THEN 0.0::DOUBLE ELSE
         least(2 * (before / target * weight) / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * (before / target * weight))), 1) END END AS position
FROM q
"""
