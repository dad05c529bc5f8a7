"""Bronze-shaped feeds derived from the driver's TPC-H-like tables.

``raw_sales`` is a pure projection of ``lineitem`` and ``raw_stores`` of ``supplier``:
no shuffle, and every filter or column pruning downstream reaches the Parquet scan.
The same expressions are written in DuckDB SQL in ``ledgerloom.plans.oracle`` so each
query has an independent oracle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import COMPACT_TS_FORMAT, ntz_lit

# --- fixed values of the derived fixtures (shared with the oracle SQL) ---
# raw_sales fault injection: NULL store token / transaction id / receipt token, short
# receipt token, bad amount, bad timestamp.
NULL_STORE_MOD = 103
NULL_TXN_MOD = 107
NULL_RECEIPT_MOD = 101
SHORT_RECEIPT_MOD = 97
BAD_AMOUNT_MOD = 83
BAD_TS_MOD = 89
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# raw_stores: first delivery, second delivery.
STORES_V1_DATE = _dt.date(2024, 1, 1)
STORES_V2_DATE = _dt.date(2024, 1, 2)
STORES_LOAD_HOUR = 6
# --- end of fixed values ---

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_time(li: DataFrame) -> Column:
    # Time of day from the keys, so transactions do not all fall on midnight.
    return li.l_shipdate + F.make_dt_interval(
        F.lit(0), (li.l_orderkey % 24).cast("int"), (li.l_partkey % 60).cast("int"), F.lit(0)
    )


def raw_sales(lineitem: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """bronze.sales_raw shape: six all-string fields plus batch_date, file_name, load_ts (and
    the columns of lineitem to keep)."""
    li = lineitem
    pk, ok = li.l_partkey, li.l_orderkey
    ts = _event_time(li)
    batch_date = F.date_add(li.l_shipdate.cast("date"), (li.l_linenumber % 3).cast("int"))
    return li.select(
        F.when(pk % NULL_STORE_MOD != 0, li.l_suppkey.cast("string")).alias("store_token"),
        F.when(
            pk % NULL_TXN_MOD != 0,
            F.concat(ok.cast("string"), F.lit("-"), li.l_linenumber.cast("string")),
        ).alias("transaction_id"),
        F.when(pk % NULL_RECEIPT_MOD == 0, F.lit(None).cast("string"))
        .when(pk % SHORT_RECEIPT_MOD == 0, F.lit("AB"))
        .otherwise(F.concat(F.lit("R"), F.lpad(pk.cast("string"), 6, "0")))
        .alias("receipt_token"),
        F.when(ok % BAD_TS_MOD == 0, F.lit("NOT_A_TIMESTAMP"))
        .when(ok % 2 == 1, F.date_format(ts, COMPACT_TS_FORMAT))
        .otherwise(F.date_format(ts, ISO_TS_FORMAT))
        .alias("transaction_time"),
        F.when(pk % BAD_AMOUNT_MOD == 0, F.lit("NOT_MONEY"))
        .otherwise(F.concat(F.lit("$"), li.l_extendedprice.cast("decimal(11,2)").cast("string")))
        .alias("amount"),
        li.l_returnflag.alias("user_role"),
        batch_date.alias("batch_date"),
        F.concat(F.lit("sales_"), F.date_format(batch_date, "yyyyMMdd"), F.lit(".csv")).alias("file_name"),
        (batch_date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), li.l_linenumber)).alias("load_ts"),
        *[li[c] for c in keep or ()],
    )


def _stores_delivery(supplier: DataFrame, version: int) -> DataFrame:
    s = supplier
    key = s.s_suppkey
    day = STORES_V1_DATE if version == 1 else STORES_V2_DATE
    load_ts = _dt.datetime.combine(day, _dt.time(STORES_LOAD_HOUR))
    if version == 1:
        rows = s.where(key % 10 != 9)
        group = F.lpad(s.s_nationkey.cast("string"), 8, "0")
        name = s.s_name
    else:
        rows = s
        group = F.lpad(
            F.when(key % 10 == 3, s.s_nationkey + 1).otherwise(s.s_nationkey).cast("string"), 8, "0"
        )
        name = (
            F.when(key % 20 == 4, F.lit(None).cast("string"))
            .when(key % 10 < 3, F.concat(s.s_name, F.lit(" Renamed")))
            .otherwise(s.s_name)
        )
    return rows.select(
        group.alias("store_group"),
        key.cast("string").alias("store_token"),
        name.alias("store_name"),
        F.lit(day).alias("batch_date"),
        F.lit(f"stores_{day:%Y%m%d}.csv").alias("file_name"),
        ntz_lit(load_ts).alias("load_ts"),
    )


def raw_stores(supplier: DataFrame, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    """bronze.stores_raw shape: two deliveries with NEW, CHANGED, SAME and NULL-name rows."""
    out = None
    for v in versions:
        d = _stores_delivery(supplier, v)
        out = d if out is None else out.unionByName(d)
    return out


def sales_raw_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales(read_table(spark, sf_dir, "lineitem"))


def stores_raw_of(spark: SparkSession, sf_dir: str, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    return raw_stores(read_table(spark, sf_dir, "supplier"), versions)
