"""Column expressions shared by every layer (no Python UDFs: all JVM-side, codegen'd).

Each helper takes and returns a ``Column`` so it composes inside ``select`` /
``withColumn`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: these must equal the source system's rules for identical results ---
# CSV tokens that mean NULL after trimming (case-sensitive: "Null" stays a value).
NULL_TOKENS = ("", "NULL", "null")
# Positional column order of the two feeds.
STORE_COLUMNS = ("store_group", "store_token", "store_name")
SALES_COLUMNS = ("store_token", "transaction_id", "receipt_token", "transaction_time", "amount", "user_role")
# File name prefixes that classify a delivery.
FILE_PREFIXES = (("stores_", "stores"), ("sales_", "sales"))
# Fallback format for compact timestamps such as 20241001T130832.000.
COMPACT_TS_FORMAT = "yyyyMMdd'T'HHmmss.SSS"
# Spellings that become ISO text by moving their digits, as (whole shape, replacement).
TS_TO_ISO = (
    (r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(\.\d{1,9})$", "$1-$2-$3T$4:$5:$6$7"),  # COMPACT_TS_FORMAT
    (r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}:\d{2}:\d{2})$", "$3-$1-$2 $4"),
)
# "Tue, 01 Oct 2024 13:08:32 +0000" and "Tue Oct 01 13:08:32 +0000 2024", with or without weekday, offset
# and seconds, as day month year time: the weekday and the offset go, as the column holds wall-clock time.
NAMED_TS_SHAPE = r"^(?:[A-Za-z]{3},? +)?(?:\d{1,2} [A-Za-z]{3}|[A-Za-z]{3} +\d{1,2}) "
NAMED_TS_REWRITES = (
    (r"^[A-Za-z]{3},? +(?=\d{1,2} [A-Za-z]{3} |[A-Za-z]{3} )", ""),
    (r"^([A-Za-z]{3}) +(\d{1,2}) +(\d{1,2}:\d{2}(?::\d{2})?)(?: +[+-]\d{2}:?\d{2})? +(\d{4})$", "$2 $1 $4 $3"),
    (r"^(\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}(?::\d{2})?) +(?:[+-]\d{2}:?\d{2}|GMT|UTC|Z)$", "$1"),
)
NAMED_TS_FORMAT = "d MMM yyyy HH:mm[:ss]"
# Amount type: decimal(11,2); sums and totals are reported as decimal(18,2).
AMOUNT_TYPE = "decimal(11,2)"
TOTAL_TYPE = "decimal(18,2)"
# Inclusive receipt token length bounds.
RECEIPT_MIN_LEN = 5
RECEIPT_MAX_LEN = 30
# Reject reasons, first match wins, in this order.
REJECT_REASONS = (
    "NULL_STORE_TOKEN",
    "NULL_TRANSACTION_ID",
    "NULL_RECEIPT_TOKEN",
    "INVALID_TIMESTAMP",
    "INVALID_AMOUNT",
    "INVALID_RECEIPT_TOKEN_LENGTH",
)
UNKNOWN_REASON = "UNKNOWN"
# High-water mark of an empty target.
EPOCH = _dt.datetime(1970, 1, 1)
# Text form of load_ts inside the surrogate key.
KEY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# --- end of fixed values ---


def ntz_lit(value: _dt.datetime | str) -> Column:
    """A timestamp_ntz literal built from text, so no time zone can shift it."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c: Column | str) -> Column:
    """Trim a raw field and map the NULL tokens ('', 'NULL', 'null') to NULL."""
    t = F.trim(col_of(c))
    return F.when(~t.isin(*NULL_TOKENS), t)


def clean_amount(c: Column | str) -> Column:
    """Strip every '$' and parse as decimal(11,2); NULL when it does not parse.

    ``try_cast`` rounds half-up, trims blanks, accepts exponents and returns NULL on
    overflow, so a bad amount becomes a reject reason instead of a failed job.
    """
    stripped = F.replace(col_of(c), F.lit("$"), F.lit(""))
    return stripped.try_cast(AMOUNT_TYPE)


def parse_transaction_time(c: Column | str) -> Column:
    """Wall-clock timestamp from an ISO-like string, from the compact format, from
    ``10/01/2024 13:08:32`` or from the two spellings with a month's name (NAMED_TS_REWRITES).

    A row takes one parser only, picked by its shape: digits-only spellings are moved into ISO
    order and cast, which neither throws nor depends on a time zone. Input is a bronze field,
    trimmed at ingestion (the cast trims as well). A bare digit run (``2024``, an epoch) is not
    accepted: Spark would read a lone year as a date, which no feed means.
    """
    raw = col_of(c)
    # a pattern is tried only on rows with the characters that it needs, or without one that it excludes
    colon, (compact, slashed) = raw.contains(":"), TS_TO_ISO
    iso = (
        F.when(colon & ~raw.contains("/"), raw)
        .when(colon, F.regexp_replace(raw, *slashed))
        .otherwise(F.regexp_replace(raw, *compact))
    )
    named = raw
    for pattern, to in NAMED_TS_REWRITES:
        named = F.regexp_replace(named, pattern, to)
    return (
        F.when(~colon & ~raw.contains("T") & raw.rlike(r"^[0-9]+$"), F.lit(None))
        .when(raw.contains(" ") & raw.rlike(NAMED_TS_SHAPE), F.try_to_timestamp(named, F.lit(NAMED_TS_FORMAT)).cast("timestamp_ntz"))
        .otherwise(iso.try_cast("timestamp_ntz"))
    )


def receipt_length_ok(c: Column | str) -> Column:
    return F.length(col_of(c)).between(RECEIPT_MIN_LEN, RECEIPT_MAX_LEN)


def reject_reason(
    store_token: Column | str,
    transaction_id: Column | str,
    receipt_token: Column | str,
    parsed_time: Column | str,
    parsed_amount: Column | str,
) -> Column:
    """First failing rule, or NULL for a valid row (so valid = ``reason IS NULL``)."""
    rt = col_of(receipt_token)
    rules = (
        col_of(store_token).isNull(),
        col_of(transaction_id).isNull(),
        rt.isNull(),
        col_of(parsed_time).isNull(),
        col_of(parsed_amount).isNull(),
        ~receipt_length_ok(rt),
    )
    expr = None
    for rule, reason in zip(rules, REJECT_REASONS):
        expr = F.when(rule, F.lit(reason)) if expr is None else expr.when(rule, F.lit(reason))
    return expr


def surrogate_key(token: Column | str, ts: Column | str) -> Column:
    """md5 of ``token|load_ts`` with the timestamp written out to milliseconds."""
    return F.md5(F.concat(col_of(token), F.lit("|"), F.date_format(col_of(ts), KEY_TS_FORMAT)))


def file_type_of(name: Column | str) -> Column:
    """'stores' / 'sales' by case-sensitive prefix of the bare file name, else NULL."""
    n = col_of(name)
    expr = None
    for prefix, kind in FILE_PREFIXES:
        cond = n.startswith(prefix)
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return expr


def file_stem(name: Column | str) -> Column:
    """File name without its last extension (``a.b.csv`` -> ``a.b``)."""
    return F.regexp_replace(col_of(name), r"\.[^.]*$", "")


def batch_date_of(name: Column | str) -> Column:
    """Date from the first run of 8 digits in the file stem; NULL when there is none."""
    digits = F.regexp_extract(file_stem(name), r"(\d{8})", 1)
    return F.when(digits != "", F.try_to_date(digits, "yyyyMMdd"))


def base_name(path: Column | str) -> Column:
    """Last path segment of a file URI."""
    return F.regexp_extract(col_of(path), r"([^/]+)$", 1)


def to_cents(amount: Column | str) -> Column:
    return (col_of(amount) * 100).cast("long")


def half_up_avg(sum_cents: Column | str, n: Column | str) -> Column:
    """Exact average of integer cents, rounded half away from zero, as decimal(18,2).

    Integer arithmetic only, so the result does not depend on how an engine types
    ``avg(decimal)``.
    """
    s, k = col_of(sum_cents).cast("long"), col_of(n).cast("long")
    mag = F.abs(s) * 2 + k
    den = k * 2
    # (mag - mag mod den) is an exact multiple of den: decimal division gives the integer.
    q = ((mag - F.pmod(mag, den)).cast("decimal(38,0)") / den.cast("decimal(38,0)")).cast("long")
    signed = F.when(s < 0, -q).otherwise(q)
    return (signed.cast("decimal(20,0)") / F.lit(100)).cast(TOTAL_TYPE)


def cents_to_total(c: Column | str) -> Column:
    return (col_of(c).cast("decimal(20,0)") / F.lit(100)).cast(TOTAL_TYPE)
