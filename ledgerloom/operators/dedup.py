"""Latest-wins deduplication, last-N values and top-k per group.

All three are written so that no step funnels the whole table through one task:

* ``latest_wins`` filters ``row_number() = 1`` right after the window, which Spark
  plans as a partial ``WindowGroupLimit`` *before* the shuffle: a key holding a third
  of all rows reaches its reducer as at most one row per map task.
* ``last_n_values`` replaces an unpartitioned ``dense_rank`` with distinct + ordered
  limit (``TakeOrderedAndProject``), so no single-partition window appears.
* ``top_k_per_group`` ranks within each group only, after aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import col_of


def _orders(order: Sequence[Column | str]) -> list[Column]:
    return [col_of(o) for o in order]


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], rank_col: str = "_rn") -> DataFrame:
    """One row per key: the first row under ``order`` (give it a total order)."""
    w = Window.partitionBy(*keys).orderBy(*_orders(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def last_n_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` largest distinct non-null values of ``column`` (distinct dates with data)."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(F.col(column).desc()).limit(n)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, rank_col: str = "rank"
) -> DataFrame:
    """At most ``k`` rows per group (ROW_NUMBER semantics: ties never add rows)."""
    w = Window.partitionBy(*group).orderBy(*_orders(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def sales_order(df: DataFrame, ts_col: str = "load_ts") -> list[Column]:
    """Total order for 'latest received wins' on sales rows.

    Arrival first (load_ts, then file name, then the line position inside the file
    when the ingest recorded it), then the payload so equal arrivals still resolve the
    same way on every run and every engine.
    """
    order = [F.col(ts_col).desc(), F.col("file_name").desc_nulls_last()]
    order += [F.col(c).desc() for c in ("src_block", "src_line") if c in df.columns]
    order += [
        F.col(c).desc_nulls_last() for c in ("amount", "receipt_token", "transaction_time", "user_role")
    ]
    return order


def store_order(df: DataFrame, ts_col: str = "load_ts") -> list[Column]:
    order = [F.col(ts_col).desc()]
    order += [F.col(c).desc_nulls_last() for c in ("file_name",) if c in df.columns]
    order += [F.col(c).desc() for c in ("src_block", "src_line") if c in df.columns]
    order += [F.col(c).desc_nulls_last() for c in ("store_group", "store_name")]
    return order
