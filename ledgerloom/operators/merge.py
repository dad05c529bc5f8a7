"""Keyed upsert, high-water slices, the fact build and the type-2 store dimension.

Plain Parquet has no MERGE, so an upsert is ``target ANTI JOIN update-keys UNION ALL
updates``. That has MERGE's semantics: a matched key has its whole row replaced,
unmatched updates are inserted (all of them, even several sharing a key), and NULL keys
never match. Catalyst picks the join by the sides' sizes: adaptive execution broadcasts
a small update set and splits skewed partitions of a shuffled one.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import EPOCH, ntz_lit, receipt_length_ok, surrogate_key
from ledgerloom.operators.dedup import latest_wins, sales_order, store_order

# --- fixed values: columns and keys of the fact and the dimension ---
FACT_COLUMNS = (
    "store_token", "transaction_id", "receipt_token", "transaction_time", "amount", "user_role", "batch_date",
    "last_load_ts",
)
FACT_KEYS = ("store_token", "transaction_id")
DIM_COLUMNS = (
    "dim_store_key", "store_token", "store_group", "store_name", "valid_from", "valid_to", "is_current",
    "first_seen_ts", "last_load_ts",
)
# --- end of fixed values ---


def upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace target rows whose key appears in ``updates``; insert the rest."""
    updates = updates.select(*(target.columns if target is not None else updates.columns))
    if target is None:
        return updates
    return target.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates)


def high_water_mark(target: DataFrame | None, ts_col: str) -> _dt.datetime:
    """``coalesce(max(ts), 1970-01-01)`` of the target, fetched as a literal.

    A literal (rather than a scalar subquery) reaches the Parquet scan as a pushed
    filter, so row groups and ``batch_date`` partitions below the mark are skipped.
    One aggregate row crosses to the driver.
    """
    if target is None:
        return EPOCH
    row = target.agg(F.max(ts_col).alias("m")).first()
    return row["m"] if row is not None and row["m"] is not None else EPOCH


def high_water_mark_df(target: DataFrame, ts_col: str) -> DataFrame:
    """Same mark as a one-row DataFrame (``mark``), for plans that keep it lazy."""
    return target.agg(F.coalesce(F.max(ts_col), ntz_lit(EPOCH)).alias("mark"))


def incremental_slice(src: DataFrame, mark: _dt.datetime | Column, ts_col: str = "load_ts") -> DataFrame:
    """Rows strictly newer than the target's own high-water mark."""
    return src.where(F.col(ts_col) > (mark if isinstance(mark, Column) else ntz_lit(mark)))


def fact_candidates(valid: DataFrame) -> DataFrame:
    """Re-check validity of silver rows (defence in depth: silver may be hand-loaded)."""
    cond = F.lit(True)
    for c in ("store_token", "transaction_id", "receipt_token", "transaction_time", "amount"):
        cond = cond & F.col(c).isNotNull()
    return valid.where(cond & receipt_length_ok("receipt_token"))


def dedup_sales(valid: DataFrame) -> DataFrame:
    """Latest received version of each (store_token, transaction_id), fact-shaped."""
    latest = latest_wins(valid, FACT_KEYS, sales_order(valid))
    return latest.select(
        "store_token", "transaction_id", "receipt_token", "transaction_time", "amount", "user_role", "batch_date",
        F.col("load_ts").alias("last_load_ts"),
    )


def build_fact(
    valid: DataFrame,
    fact: DataFrame | None = None,
    mark: _dt.datetime | None = None,
) -> DataFrame:
    """gold.fact_sales: slice above the fact's mark, re-check, dedup, upsert."""
    src = fact_candidates(valid)
    if fact is not None:
        if mark is None:
            mark = high_water_mark(fact, "last_load_ts")
        src = incremental_slice(src, mark)
    return upsert(fact, dedup_sales(src), FACT_KEYS)


# ---------------------------------------------------------------- SCD type 2


def latest_stores(stores_clean: DataFrame) -> DataFrame:
    return latest_wins(stores_clean, ["store_token"], store_order(stores_clean)).select(
        "store_token", "store_group", "store_name", "load_ts"
    )


def scd2_initial(stores_clean: DataFrame) -> DataFrame:
    """First load: only the latest version of each store becomes an open row."""
    latest = latest_stores(stores_clean)
    ts = F.col("load_ts")
    return latest.select(
        surrogate_key("store_token", ts).alias("dim_store_key"),
        "store_token",
        "store_group",
        "store_name",
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
        ts.alias("first_seen_ts"),
        ts.alias("last_load_ts"),
    )


def _against_current(dim: DataFrame, stores_clean: DataFrame) -> DataFrame:
    """Every dimension row as struct ``d`` next to the incoming version ``n`` of its store, if
    it is the store's open row; incoming stores without an open row come alone. ``status``
    is NULL where nothing came in."""
    d = dim.select(F.struct(*dim.columns).alias("d"))
    n = latest_stores(stores_clean).select(F.struct("store_token", "store_group", "store_name", "load_ts").alias("n"))
    same_store = F.col("d.is_current") & (F.col("d.store_token") == F.col("n.store_token"))
    differs = ~F.struct("d.store_group", "d.store_name").eqNullSafe(F.struct("n.store_group", "n.store_name"))
    status = F.when(F.col("n").isNotNull(), F.when(F.col("d").isNull(), "NEW").when(differs, "CHANGED").otherwise("SAME"))
    return d.join(n, same_store, "full").withColumn("status", status)


def scd2_changes(dim: DataFrame, stores_clean: DataFrame) -> DataFrame:
    """(store_token, change_status): each incoming store is NEW, CHANGED or SAME."""
    met = _against_current(dim, stores_clean).where("status is not null")
    return met.select(F.col("n.store_token").alias("store_token"), F.col("status").alias("change_status"))


def scd2_apply(dim: DataFrame | None, stores_clean: DataFrame, incremental: bool = True) -> DataFrame:
    """Close changed rows and open new versions; all other rows stay as they are.

    One outer join yields every row of the result: a changed store's pair becomes two rows
    (the closed one and its successor) by ``explode``, so no input is read twice.
    ``incremental`` first slices ``stores_clean`` above the dimension's mark; versions at or
    below it were seen by an earlier run, so the result is the same.
    """
    if dim is None:
        return scd2_initial(stores_clean)
    if incremental:
        stores_clean = incremental_slice(stores_clean, high_water_mark(dim, "last_load_ts"))
    met = _against_current(dim, stores_clean)
    at = F.col("n.load_ts")
    kept = F.struct(*[F.col("d")[c].alias(c) for c in DIM_COLUMNS])
    ended = {"valid_to": at, "is_current": F.lit(False), "last_load_ts": at}
    closed = F.struct(*[ended.get(c, F.col("d")[c]).alias(c) for c in DIM_COLUMNS])
    begun = {
        "dim_store_key": surrogate_key(F.col("n.store_token"), at),
        "store_token": F.col("n.store_token"),
        "store_group": F.col("n.store_group"),
        "store_name": F.col("n.store_name"),
        "valid_from": at,
        "valid_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
        "first_seen_ts": F.coalesce("d.first_seen_ts", at),
        "last_load_ts": at,
    }
    opened = F.struct(*[begun[c].alias(c) for c in DIM_COLUMNS])
    rows = (
        F.when(F.col("status") == "NEW", F.array(opened))
        .when(F.col("status") == "CHANGED", F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    return met.select(F.explode(rows).alias("r")).select("r.*")


def scd2_history(stores_clean: DataFrame) -> DataFrame:
    """The whole dimension out of all versions ever delivered, in any order: consecutive versions
    with equal attributes are one interval (an island), which ends where the next begins."""
    same = ["store_token", "load_ts"]
    once = latest_wins(stores_clean, same, store_order(stores_clean)).select(*same, "store_group", "store_name")
    by_time = Window.partitionBy("store_token").orderBy("load_ts")
    once = once.withColumns({
        "before": F.lag(F.struct("store_group", "store_name")).over(by_time),
        "first_seen_ts": F.min("load_ts").over(Window.partitionBy("store_token")),
    })
    begins = ~F.col("before").eqNullSafe(F.struct("store_group", "store_name"))
    rows = once.where(begins).withColumn("valid_to", F.lead("load_ts").over(by_time))
    return rows.select(
        surrogate_key("store_token", "load_ts").alias("dim_store_key"),
        "store_token", "store_group", "store_name",
        F.col("load_ts").alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        "first_seen_ts",
        F.coalesce("valid_to", "load_ts").alias("last_load_ts"),
    )


def scd2_splice(dim: DataFrame | None, news: DataFrame, known: DataFrame) -> DataFrame:
    """The dimension after versions that may be older than those it holds: the stores of ``news`` are
    built anew from ``known``, all their versions (``news`` among them); the others stay."""
    if dim is None:
        return scd2_history(known)
    tokens = news.select("store_token").distinct()
    rebuilt = scd2_history(known.join(tokens, "store_token", "left_semi"))
    return dim.join(tokens, "store_token", "left_anti").unionByName(rebuilt)


def dim_current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))
