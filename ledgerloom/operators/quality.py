"""Silver quality gate: type the raw strings once and split valid from rejected.

Both outputs come from one projection of the raw rows (no shuffle, no join); a row is
valid exactly when its reject reason is NULL, so the two sides are exact complements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    STORE_COLUMNS,
    clean_amount,
    parse_transaction_time,
    reject_reason,
)

# Lineage columns a CSV ingest adds for in-file ordering; carried through when present.
LINE_COLUMNS = ("src_block", "src_line")


def _extra_lineage(df: DataFrame) -> list[str]:
    return [c for c in LINE_COLUMNS if c in df.columns]


def parse_sales(raw: DataFrame) -> DataFrame:
    """Raw sales with ``parsed_time``, ``parsed_amount`` and ``reject_reason`` added.

    The three come out of a one-element ``inline``: the optimizer moves no filter on them below
    it, so a row is parsed once, however its reject reason is filtered afterwards. Filters on
    the raw columns still reach the scan.
    """
    typed = F.struct(parse_transaction_time("transaction_time").alias("parsed_time"), clean_amount("amount").alias("parsed_amount"))
    parsed = raw.select("*", F.inline(F.array(typed)))
    reason = reject_reason("store_token", "transaction_id", "receipt_token", "parsed_time", "parsed_amount")
    return parsed.withColumn("reject_reason", reason)


def valid_from_parsed(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).select(
        "store_token",
        "transaction_id",
        "receipt_token",
        F.col("parsed_time").alias("transaction_time"),
        F.col("parsed_amount").alias("amount"),
        "user_role",
        "batch_date",
        "file_name",
        "load_ts",
        *_extra_lineage(parsed),
    )


def rejected_from_parsed(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        "store_token",
        "transaction_id",
        "receipt_token",
        F.col("transaction_time").alias("transaction_time_raw"),
        F.col("amount").alias("amount_raw"),
        "user_role",
        "batch_date",
        "file_name",
        "load_ts",
        "reject_reason",
        *_extra_lineage(parsed),
    )


def split_quality(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sales_valid, sales_rejected) from bronze sales rows.

    Valid rows carry the typed ``transaction_time`` (timestamp_ntz) and ``amount``
    (decimal(11,2)); rejected rows keep the raw strings and the first failing reason.
    When both sides are written, persist ``parse_sales(raw)`` first so the raw scan
    and parse run once.
    """
    parsed = parse_sales(raw)
    return valid_from_parsed(parsed), rejected_from_parsed(parsed)


def sales_valid(raw: DataFrame) -> DataFrame:
    return valid_from_parsed(parse_sales(raw))


def sales_rejected(raw: DataFrame) -> DataFrame:
    return rejected_from_parsed(parse_sales(raw))


def reject_reason_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def clean_stores(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Store rows with all three attributes present; others are dropped silently.

    ``strict=True`` also enforces the documented formats: an 8-character upper-case
    hex group, a lower-case UUID token and a name shorter than 200 characters.
    """
    cond = F.lit(True)
    for c in STORE_COLUMNS:
        cond = cond & F.col(c).isNotNull()
    if strict:
        cond = (
            cond
            & F.col("store_group").rlike(r"^[0-9A-F]{8}$")
            & F.col("store_token").rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")
            & (F.length("store_name") < 200)
        )
    return raw.where(cond).select(
        *STORE_COLUMNS, "batch_date", "load_ts", *[c for c in ("file_name", *LINE_COLUMNS) if c in raw.columns]
    )
