"""DuckDB SQL for every registered query: an independent oracle of the Spark plans.

The views ``lineitem``, ``supplier``, ... are registered by the caller. Results are derived
from the definitions by other means than the Spark code's: report 1 as one grouped pass over
tagged rows, top stores by ``arg_max`` or by counting better ones, month totals by a
correlated sum, and the dimension's history by ``lead`` over each store's versions.
"""

from __future__ import annotations

from ledgerloom.operators import checks
from ledgerloom.plans import catalog
from ledgerloom.sources import csv_inbox

SNAP = f"DATE '{catalog.SNAPSHOT_DATE.isoformat()}'"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def tot(x: str) -> str:
    """Integer cents -> decimal(18,2), exactly."""
    return f"CAST(CAST({x} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def avg_half_up(s: str, n: str) -> str:
    return (
        f"CAST(CAST((CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DECIMAL(18,0))"
        f" * 0.01 AS DECIMAL(18,2))"
    )


_FIELDS = """    CASE WHEN l_partkey % 103 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS store_token,
    CASE WHEN l_partkey % 107 <> 0 THEN CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END
      AS transaction_id,
    CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 'AB'
         ELSE 'R' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') END AS receipt_token,
    CASE WHEN l_orderkey % 89 = 0 THEN 'NOT_A_TIMESTAMP'
         WHEN l_orderkey % 2 = 1 THEN strftime(ets, '%Y%m%dT%H%M%S.%g')
         ELSE strftime(ets, '%Y-%m-%dT%H:%M:%S') END AS transaction_time,
    CASE WHEN l_partkey % 83 = 0 THEN 'NOT_MONEY'
         ELSE '$' || CAST(CAST(l_extendedprice AS DECIMAL(11,2)) AS VARCHAR) END AS amount,
    l_returnflag AS user_role,
"""
_TIMED = """(
    SELECT *,
      l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_partkey % 60 AS INTEGER)) AS ets,
      CAST(l_shipdate AS DATE) + CAST(l_linenumber % 3 AS INTEGER) AS bd
    FROM lineitem
  ) li"""
RAW = f"""raw AS (
  SELECT
{_FIELDS}    bd AS batch_date,
    'sales_' || strftime(bd, '%Y%m%d') || '.csv' AS file_name,
    CAST(bd AS TIMESTAMP) + to_hours(l_linenumber) AS load_ts
  FROM {_TIMED}
)"""

PARSED = """parsed AS (
  SELECT *,
    CASE WHEN regexp_matches(transaction_time, '^[0-9]+$') THEN NULL
         ELSE coalesce(try_cast(transaction_time AS TIMESTAMP),
                       try_strptime(transaction_time, '%Y%m%dT%H%M%S.%g')) END AS parsed_time,
    try_cast(replace(amount, '$', '') AS DECIMAL(11,2)) AS parsed_amount
  FROM raw
),
classified AS (
  SELECT *,
    CASE WHEN store_token IS NULL THEN 'NULL_STORE_TOKEN'
         WHEN transaction_id IS NULL THEN 'NULL_TRANSACTION_ID'
         WHEN receipt_token IS NULL THEN 'NULL_RECEIPT_TOKEN'
         WHEN parsed_time IS NULL THEN 'INVALID_TIMESTAMP'
         WHEN parsed_amount IS NULL THEN 'INVALID_AMOUNT'
         WHEN length(receipt_token) NOT BETWEEN 5 AND 30 THEN 'INVALID_RECEIPT_TOKEN_LENGTH' END AS reject_reason
  FROM parsed
),
valid AS (
  SELECT store_token, transaction_id, receipt_token, parsed_time AS transaction_time, parsed_amount AS amount,
         user_role, batch_date, file_name, load_ts
  FROM classified WHERE reject_reason IS NULL
),
rejected AS (
  SELECT store_token, transaction_id, receipt_token, transaction_time AS transaction_time_raw, amount AS amount_raw,
         user_role, batch_date, file_name, load_ts, reject_reason
  FROM classified WHERE reject_reason IS NOT NULL
)"""


def dedup(src: str) -> str:
    return f"""
  SELECT store_token, transaction_id, receipt_token, transaction_time, amount, user_role, batch_date,
         load_ts AS last_load_ts
  FROM {src} AS s
  WHERE store_token IS NOT NULL AND transaction_id IS NOT NULL AND receipt_token IS NOT NULL
    AND transaction_time IS NOT NULL AND amount IS NOT NULL AND length(receipt_token) BETWEEN 5 AND 30
  QUALIFY row_number() OVER (
    PARTITION BY store_token, transaction_id
    ORDER BY load_ts DESC, file_name DESC NULLS LAST, amount DESC NULLS LAST, receipt_token DESC NULLS LAST,
             transaction_time DESC NULLS LAST, user_role DESC NULLS LAST) = 1"""


FACT = f"fact AS ({dedup('valid')}\n)"
_BATCH1 = f"(SELECT * FROM valid WHERE batch_date < DATE '{catalog.MERGE_CUTOFF.isoformat()}')"
FACT1 = f"fact1 AS ({dedup(_BATCH1)}\n)"
SALES = f"WITH {RAW},\n{PARSED}"
SALES_FACT = f"{SALES},\n{FACT}"

RAW_STORES = """raw_stores AS (
  SELECT lpad(CAST(s_nationkey AS VARCHAR), 8, '0') AS store_group, CAST(s_suppkey AS VARCHAR) AS store_token,
         s_name AS store_name, DATE '2024-01-01' AS batch_date, 'stores_20240101.csv' AS file_name,
         TIMESTAMP '2024-01-01 06:00:00' AS load_ts, 1 AS version
  FROM supplier WHERE s_suppkey % 10 <> 9
  UNION ALL
  SELECT lpad(CAST(CASE WHEN s_suppkey % 10 = 3 THEN s_nationkey + 1 ELSE s_nationkey END AS VARCHAR), 8, '0'),
         CAST(s_suppkey AS VARCHAR),
         CASE WHEN s_suppkey % 20 = 4 THEN NULL WHEN s_suppkey % 10 < 3 THEN s_name || ' Renamed' ELSE s_name END,
         DATE '2024-01-02', 'stores_20240102.csv', TIMESTAMP '2024-01-02 06:00:00', 2
  FROM supplier
),
clean_all AS (
  SELECT store_group, store_token, store_name, batch_date, load_ts, file_name, version FROM raw_stores
  WHERE store_group IS NOT NULL AND store_token IS NOT NULL AND store_name IS NOT NULL
)"""


def latest_stores(src: str) -> str:
    return f"""
  SELECT store_token, store_group, store_name, load_ts FROM {src} AS s
  QUALIFY row_number() OVER (PARTITION BY store_token
    ORDER BY load_ts DESC, file_name DESC NULLS LAST, store_group DESC NULLS LAST, store_name DESC NULLS LAST) = 1"""


KEY = "md5(store_token || '|' || strftime(load_ts, '%Y-%m-%d %H:%M:%S.%g'))"

DIM1 = f"""latest1 AS ({latest_stores('(SELECT * FROM clean_all WHERE version = 1)')}
),
dim1 AS (
  SELECT {KEY} AS dim_store_key, store_token, store_group, store_name, load_ts AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, load_ts AS first_seen_ts, load_ts AS last_load_ts
  FROM latest1
)"""


# Each store's versions in order: what the dimension holds, then the newest delivered one
# unless it says the same. A version ends where the next begins.
VERSIONS = f"""mark AS (SELECT coalesce(max(last_load_ts), {EPOCH}) AS newest FROM dim1),
said AS (
  SELECT store_token, store_group, store_name, valid_from AS ts, 0 AS incoming FROM dim1
  UNION ALL
  SELECT store_token, store_group, store_name, load_ts, 1
  FROM ({latest_stores("(SELECT * FROM clean_all WHERE load_ts > (SELECT newest FROM mark))")})
),
kept AS (
  SELECT * FROM said s WHERE incoming = 0 OR NOT EXISTS (
    SELECT 1 FROM said o WHERE o.incoming = 0 AND o.store_token = s.store_token
      AND (o.store_group, o.store_name) IS NOT DISTINCT FROM (s.store_group, s.store_name))
)"""
DIM = f"""{DIM1},
{VERSIONS},
dim AS (
  SELECT md5(store_token || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g')) AS dim_store_key, store_token, store_group,
         store_name, ts AS valid_from, lead(ts) OVER later AS valid_to, lead(ts) OVER later IS NULL AS is_current,
         min(ts) OVER (PARTITION BY store_token) AS first_seen_ts, coalesce(lead(ts) OVER later, ts) AS last_load_ts
  FROM kept WINDOW later AS (PARTITION BY store_token ORDER BY incoming)
)"""

PER_STORE = """per_store AS (
  SELECT CAST(transaction_time AS DATE) AS day, store_token AS store, CAST(sum(amount * 100) AS BIGINT) AS cents,
         count(*) AS sales
  FROM fact GROUP BY ALL
),
per_day AS (
  SELECT day, count(*) AS stores, CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(sales) AS BIGINT) AS sales,
         arg_max(store, (cents, -rank_in_names)) AS best_store, max(cents) AS best_cents
  FROM (SELECT p.*, dense_rank() OVER (ORDER BY store) AS rank_in_names FROM per_store p) GROUP BY day
)"""


def newest_days(n: int) -> str:
    return f"(SELECT day FROM per_day ORDER BY day DESC LIMIT {n})"


def month_so_far(d: str) -> str:
    return (
        f"(SELECT CAST(sum(e.cents) AS BIGINT) FROM per_day e "
        f"WHERE e.day BETWEEN date_trunc('month', {d}.day) AND {d}.day)"
    )


REPORT_DAILY = f"""report_daily AS (
  SELECT {SNAP} AS snapshot_date, d.day AS transaction_date, d.stores AS stores_with_tx,
         {tot('d.cents')} AS total_sales_amount, {avg_half_up('d.cents', 'd.sales')} AS total_sales_avg,
         {tot(month_so_far('d'))} AS month_accumulated_sales, d.best_store AS top_store_token
  FROM per_day d WHERE d.day IN {newest_days(40)}
)"""

REPORT_TOPK = f"""report_topk AS (
  SELECT {SNAP} AS snapshot_date, p.day AS transaction_date, CAST(1 + b.better AS BIGINT) AS top_rank_id,
         {tot('p.cents')} AS store_total_sales, p.store AS store_token,
         (SELECT any_value(s.store_name) FROM dim s WHERE s.is_current AND s.store_token = p.store) AS store_name
  FROM per_store p JOIN (
    SELECT x.day, x.store, count(y.store) AS better
    FROM per_store x LEFT JOIN per_store y
      ON y.day = x.day AND (y.cents > x.cents OR y.cents = x.cents AND y.store < x.store)
    WHERE x.day IN {newest_days(10)} GROUP BY ALL
  ) b ON b.day = p.day AND b.store = p.store
  WHERE b.better < 5
)"""

REPORT_BATCHES = f"""report_batches AS (
  SELECT {SNAP} AS snapshot_date, batch_date, count(*) FILTER (WHERE tag = 'raw') AS total_processed_raw,
         count(*) FILTER (WHERE tag = 'fact') AS total_valid, count(*) FILTER (WHERE tag = 'bad') AS total_invalid,
         coalesce(CAST(max(load_ts) FILTER (WHERE tag = 'raw') AS DATE), {SNAP}) AS processing_date
  FROM (
    SELECT 'raw' AS tag, batch_date, load_ts FROM raw
    UNION ALL SELECT 'fact', batch_date, NULL FROM fact
    UNION ALL SELECT 'bad', batch_date, NULL FROM rejected
  )
  GROUP BY batch_date HAVING bool_or(tag = 'raw') ORDER BY batch_date DESC LIMIT 40
)"""


MANIFEST = f"""manifest AS (
  SELECT split_part(file_name, '_', 1) AS file_type,
         CAST(strptime(regexp_extract(file_name, '[0-9]{{8}}'), '%Y%m%d') AS DATE) AS batch_date,
         file_name, rank() OVER (ORDER BY file_name) - 1 AS file_order, row_count,
         TIMESTAMP '{catalog.RUN_LOG_TS:%Y-%m-%d %H:%M:%S}' + to_milliseconds(rank() OVER (ORDER BY file_name) - 1) AS load_ts
  FROM (SELECT file_name, count(*) AS row_count FROM raw GROUP BY file_name)
),
tagged AS (
  SELECT *, batch_date <= max(batch_date) OVER () - {catalog.LOGGED_BEFORE_DAYS} AS logged FROM manifest
)"""


def _not_null_sql(table: str, cte: str) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {cte}"
        for c in checks.NOT_NULL[table]
    ]
    return "\nUNION ALL\n".join(parts)


def _unique_sql(table: str, cte: str, keys) -> str:
    k = ", ".join(keys)
    return (
        f"SELECT '{table}' AS table_name, 'unique' AS check_name, '{','.join(keys)}' AS column_name, "
        f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {k} FROM {cte} GROUP BY {k} HAVING count(*) > 1) x"
    )


def _ts(dt) -> str:
    return f"TIMESTAMP '{dt:%Y-%m-%d %H:%M:%S}'"


# lineitem as CSV deliveries: two days of four files; short lines lack the last two fields
# and some roles are quoted with a comma.
_DAY2 = f"l_shipdate >= DATE '{catalog.MERGE_CUTOFF.isoformat()}'"


def delivered(one_run: bool, breaks: bool = False) -> str:
    """The deliveries' rows; load stamps as of one run over both days, or of a run for each; quoted
    roles with a line break or without."""
    quoted = "',' || chr(10) || ' x'" if breaks else "', x'"
    number = f"l_orderkey % {catalog.DELIVERY_FILES}"
    if one_run:
        at = f"{_ts(catalog.RUN_LOG_TS)} + to_milliseconds({number} + CASE WHEN {_DAY2} THEN {catalog.DELIVERY_FILES} ELSE 0 END)"
    else:
        at = f"CAST(day AS TIMESTAMP) + INTERVAL {catalog.RUN_TIME.hour} HOUR + to_milliseconds({number})"
    d1, d2 = (f"DATE '{d.isoformat()}'" for d in catalog.DELIVERY_DAYS)
    return f"""raw AS (
  SELECT * REPLACE (
      CASE WHEN l_partkey % {catalog.SHORT_MOD} <> 0 THEN amount END AS amount,
      CASE WHEN l_partkey % {catalog.SHORT_MOD} = 0 THEN NULL
           WHEN l_partkey % {catalog.QUOTED_MOD} = 0 AND l_partkey % {catalog.SHORT_MOD} <> 0 THEN user_role || {quoted}
           ELSE user_role END AS user_role),
    day AS batch_date, 'sales_' || strftime(day, '%Y%m%d') || '_' || CAST({number} AS VARCHAR) || '.csv' AS file_name,
    {at} AS load_ts
  FROM (
    SELECT
{_FIELDS}      l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_returnflag,
      CASE WHEN {_DAY2} THEN {d2} ELSE {d1} END AS day
    FROM {_TIMED})
)"""


_SALES_RAW = "store_token, transaction_id, receipt_token, transaction_time, amount, user_role, batch_date, file_name, load_ts"
# a file's later line wins, and its lines are in this order
_LINES = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_shipdate DESC, l_returnflag DESC"
DELIVERED_FACT = f"""fact AS (
  SELECT store_token, transaction_id, parsed_time AS transaction_time, parsed_amount AS amount, batch_date
  FROM classified WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY store_token, transaction_id ORDER BY load_ts DESC, {_LINES}) = 1
)"""
# the store files come after the sales files of their run
_STORES_AT = f"INTERVAL {catalog.RUN_TIME.hour} HOUR + to_milliseconds({catalog.DELIVERY_FILES})"
DELIVERED_STORES = RAW_STORES.replace("06:00:00", "00:00:00").replace(
    "SELECT store_group, store_token, store_name, batch_date, load_ts,",
    f"SELECT store_group, store_token, store_name, batch_date, load_ts + {_STORES_AT} AS load_ts,")


def _told(table: str, keys: str, values: list[str]) -> str:
    v = " || '|' || ".join(f"coalesce(CAST({x} AS VARCHAR), '-')" for x in values)
    return f"SELECT '{table}' AS table_name, {keys} AS k, {v} AS v FROM {{}}"


def _stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%g')"


_RESULTS = "\nUNION ALL\n".join([
    _told("fact_sales", "CAST(day AS VARCHAR)", ["sales", tot("cents")]).format("per_day"),
    _told("dim_store", "dim_store_key", ["store_token", "store_group", "store_name", _stamp("valid_from"),
          _stamp("valid_to"), "is_current", _stamp("first_seen_ts")]).format("dim"),
    _told("report_batches", "CAST(batch_date AS VARCHAR)", ["snapshot_date", "total_processed_raw", "total_valid",
          "total_invalid", "processing_date"]).format("report_batches"),
    _told("report_daily", "CAST(transaction_date AS VARCHAR)", ["stores_with_tx", "total_sales_amount",
          "total_sales_avg", "month_accumulated_sales", "top_store_token"]).format("report_daily"),
    _told("report_topk", "CAST(transaction_date AS VARCHAR) || '|' || CAST(top_rank_id AS VARCHAR)",
          ["store_total_sales", "store_token", "store_name"]).format("report_topk"),
])


def _ordered(report: str, key: str, values: list[str], order: str) -> str:
    """A report with the places of its rows, as it is read and as it is exported."""
    v = " || '|' || ".join(f"coalesce(CAST({x} AS VARCHAR), '-')" for x in values)
    return f"""SELECT how || ':{report}' AS output, row_number() OVER (PARTITION BY how ORDER BY {order}) AS place,
  CAST({key} AS VARCHAR) AS k, {v} AS v FROM {report}, (SELECT unnest(['read', 'csv']) AS how)"""


_OUTPUTS = "\nUNION ALL\n".join([
    _ordered("report_batches", "batch_date", ["total_processed_raw", "total_valid", "total_invalid"], "batch_date DESC"),
    _ordered("report_daily", "transaction_date", ["total_sales_amount", "top_store_token"], "transaction_date DESC"),
    _ordered("report_topk", "transaction_date", ["top_rank_id", "store_total_sales", "store_token", "store_name"],
             "transaction_date DESC, top_rank_id"),
    # the first file of a day has a header line
    """SELECT 'archive', 0, 'sales/' || strftime(batch_date, '%Y%m%d') || '/' || file_name,
  CAST(count(*) + CASE WHEN file_name LIKE '%\\_0.csv' ESCAPE '\\' THEN 1 ELSE 0 END AS VARCHAR) FROM raw GROUP BY batch_date, file_name""",
])
_D1, _D2 = (f"sales_{d:%Y%m%d}" for d in catalog.DELIVERY_DAYS)
_LOADED = "SELECT file_name, batch_date, count(*) AS n FROM raw GROUP BY ALL"

ORACLE_SQL: dict[str, str] = {
    "ingest_quoted_breaks": f"WITH {delivered(True, True)}\nSELECT {_SALES_RAW} FROM raw",
    "ingest_errors": f"""WITH {delivered(True)}
SELECT DISTINCT 'sales' AS file_type, batch_date, file_name, 1 AS n_lines, '{csv_inbox.REASON_OPEN_QUOTE}' AS reason,
       '{catalog.OPEN_LINE}' AS text FROM raw""",
    "ingest_content_gate": f"""WITH {delivered(True)},
n AS (SELECT count(*) AS n FROM raw WHERE file_name = '{_D2}_0.csv')
SELECT * FROM (VALUES
  ('sales_20240105_0.csv', 'sales', DATE '2024-01-05', 'SKIPPED', '{csv_inbox.REASON_CONTENT}', 0::BIGINT),
  ('sales_20240105_1.csv', 'sales', DATE '2024-01-05', 'SKIPPED', '{csv_inbox.REASON_CONTENT}', 0),
  ('{_D1}_2.csv', 'sales', DATE '{catalog.DELIVERY_DAYS[0]}', 'SKIPPED', '{csv_inbox.REASON_CHANGED}', 0),
  ('{_D1}_3.csv', 'sales', DATE '{catalog.DELIVERY_DAYS[0]}', 'SKIPPED', '{csv_inbox.REASON_ALREADY}', 0)
) t(file_name, file_type, batch_date, status, reason, row_count)
UNION ALL SELECT '{_D2}_0.csv', 'sales', DATE '{catalog.DELIVERY_DAYS[1]}', 'LOADED', NULL, n FROM n""",
    "dim_scd2_any_order": f"WITH {RAW_STORES},\n{DIM}\nSELECT * FROM dim",
    "distinct_stores_by_window": f"""{SALES_FACT},
sold AS (SELECT DISTINCT CAST(transaction_time AS DATE) AS day, store_token FROM fact)
SELECT 'day' AS kind, day AS period, count(DISTINCT store_token) AS stores FROM sold GROUP BY day
UNION ALL SELECT 'month', CAST(date_trunc('month', day) AS DATE), count(DISTINCT store_token) FROM sold GROUP BY ALL
UNION ALL SELECT 'week', d.day, count(DISTINCT s.store_token) FROM (SELECT DISTINCT day FROM sold) d
  JOIN sold s ON s.day BETWEEN d.day - {catalog.TRAILING_DAYS - 1} AND d.day GROUP BY d.day""",
    "daily_run_outputs": f"""WITH {delivered(False)},
{PARSED},
{DELIVERED_FACT},
{DELIVERED_STORES},
{DIM},
{PER_STORE},
{REPORT_BATCHES},
{REPORT_DAILY},
{REPORT_TOPK}
{_OUTPUTS}""",
    "sales_stream_fact": f"WITH {delivered(False)},\n{PARSED},\n{DELIVERED_FACT}\nSELECT * FROM fact",
    "ingest_sales_roundtrip": f"WITH {delivered(True)}\nSELECT {_SALES_RAW} FROM raw",
    "ingest_summary": f"""WITH {delivered(True)},
files AS ({_LOADED}),
steps AS (SELECT unnest(['first', 'second', 'log']) AS step)
SELECT step, file_name, 'sales' AS file_type, batch_date, CASE step WHEN 'second' THEN 'SKIPPED' ELSE 'LOADED' END AS status,
       CASE step WHEN 'second' THEN 'already processed (filename)' END AS reason,
       CASE step WHEN 'second' THEN 0 ELSE n END AS row_count
FROM files, steps""",
    "daily_run_two_deliveries": f"""WITH {delivered(False)},
{PARSED},
{DELIVERED_FACT},
{DELIVERED_STORES},
{DIM},
{PER_STORE},
{REPORT_BATCHES},
{REPORT_DAILY},
{REPORT_TOPK}
{_RESULTS}""",
    "amount_clean": f"""WITH {RAW}
SELECT store_token, transaction_id, load_ts, amount AS amount_raw,
       try_cast(replace(amount, '$', '') AS DECIMAL(11,2)) AS amount
FROM raw""",
    "timestamp_parse": f"""{SALES}
SELECT store_token, transaction_id, load_ts, transaction_time AS transaction_time_raw, parsed_time AS transaction_time
FROM parsed""",
    "null_tokens": """SELECT l_orderkey, l_linenumber, raw_field,
       CASE WHEN trim(raw_field) IN ('', 'NULL', 'null') THEN NULL ELSE trim(raw_field) END AS value
FROM (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_partkey % 11 = 0 THEN 'NULL' WHEN l_partkey % 11 = 1 THEN 'null'
              WHEN l_partkey % 11 = 2 THEN '' WHEN l_partkey % 11 = 3 THEN 'Null'
              WHEN l_partkey % 11 = 4 THEN '   '
              ELSE '  ' || l_returnflag || l_linestatus || ' ' END AS raw_field
  FROM lineitem) t""",
    "sales_valid": f"{SALES}\nSELECT * FROM valid",
    "sales_rejected": f"{SALES}\nSELECT * FROM rejected",
    "reject_reason_counts": f"{SALES}\nSELECT reject_reason, count(*) AS n_rows FROM rejected GROUP BY reject_reason",
    "stores_clean": f"WITH {RAW_STORES}\nSELECT store_group, store_token, store_name, batch_date, load_ts, file_name "
                    f"FROM clean_all",
    "fact_dedup": f"{SALES_FACT}\nSELECT * FROM fact",
    "fact_merge_two_batches": f"""{SALES},
{FACT1},
upd AS ({dedup(f"(SELECT * FROM valid WHERE load_ts > (SELECT coalesce(max(last_load_ts), {EPOCH}) FROM fact1))")}
)
SELECT * FROM fact1 f WHERE NOT EXISTS (
  SELECT 1 FROM upd u WHERE u.store_token = f.store_token AND u.transaction_id = f.transaction_id)
UNION ALL
SELECT * FROM upd""",
    "high_water_slice": f"""{SALES},
{FACT1}
SELECT * FROM valid WHERE load_ts > (SELECT coalesce(max(last_load_ts), {EPOCH}) FROM fact1)""",
    "scalar_max_default": f"""{SALES},
{FACT1},
{RAW_STORES}
SELECT 'sales_valid' AS table_name, coalesce(max(load_ts), {EPOCH}) AS mark FROM valid
UNION ALL SELECT 'fact_sales_batch1', coalesce(max(last_load_ts), {EPOCH}) FROM fact1
UNION ALL SELECT 'stores_clean', coalesce(max(load_ts), {EPOCH}) FROM clean_all
UNION ALL SELECT 'empty_slice', coalesce(max(load_ts), {EPOCH}) FROM valid
  WHERE load_ts > (SELECT max(load_ts) FROM valid)""",
    "dim_scd2_initial": f"WITH {RAW_STORES},\n{DIM1}\nSELECT * FROM dim1",
    "dim_changes": f"""WITH {RAW_STORES},
{DIM1},
newest AS ({latest_stores('clean_all')})
SELECT store_token, CASE count(DISTINCT held) WHEN 1 THEN 'NEW' ELSE
         CASE count(DISTINCT (store_group, store_name)) WHEN 1 THEN 'SAME' ELSE 'CHANGED' END END AS change_status
FROM (SELECT store_token, store_group, store_name, false AS held FROM newest
      UNION ALL SELECT store_token, store_group, store_name, true FROM dim1 WHERE is_current)
GROUP BY store_token HAVING bool_or(NOT held)""",
    "dim_scd2_apply": f"WITH {RAW_STORES},\n{DIM}\nSELECT * FROM dim",
    "dim_current": f"WITH {RAW_STORES},\n{DIM}\nSELECT * FROM dim WHERE is_current",
    "report_batches": f"{SALES_FACT},\n{REPORT_BATCHES}\nSELECT * FROM report_batches",
    "report_daily": f"{SALES_FACT},\n{PER_STORE},\n{REPORT_DAILY}\nSELECT * FROM report_daily",
    "mtd_running_total": f"""{SALES_FACT},
{PER_STORE}
SELECT d.day AS transaction_date, {tot('d.cents')} AS total_sales_amount,
       {tot(month_so_far('d'))} AS month_accumulated_sales
FROM per_day d""",
    "top_store_per_day": f"""{SALES_FACT},
{PER_STORE}
SELECT day AS transaction_date, best_store AS top_store_token, {tot('best_cents')} AS top_store_total FROM per_day""",
    "last_n_dates": f"{SALES_FACT},\n{PER_STORE}\nSELECT day AS transaction_date FROM per_day WHERE day IN {newest_days(40)}",
    "report_topk": f"{SALES_FACT},\n{RAW_STORES},\n{DIM},\n{PER_STORE},\n{REPORT_TOPK}\nSELECT * FROM report_topk",
    "file_manifest": f"WITH {RAW},\n{MANIFEST}\nSELECT * FROM manifest",
    "pending_files": f"""WITH {RAW},
{MANIFEST}
SELECT file_type, batch_date, file_name, row_count FROM tagged WHERE NOT logged""",
    "ingestion_log": f"""WITH {RAW},
{MANIFEST}
SELECT epoch_ms(loaded_at) * 1000000 + file_order AS file_id, file_type, batch_date, file_name,
       file_name AS content_hash, row_count, 'LOADED' AS status, loaded_at
FROM (SELECT *, CASE WHEN logged THEN {_ts(catalog.PRIOR_LOG_TS)} ELSE {_ts(catalog.RUN_LOG_TS)} END AS loaded_at FROM tagged)""",
    "check_not_null": f"""{SALES_FACT},
{RAW_STORES},
{DIM},
{PER_STORE},
{REPORT_BATCHES},
{REPORT_DAILY},
{REPORT_TOPK}
{_not_null_sql('fact_sales', 'fact')}
UNION ALL
{_not_null_sql('dim_store', 'dim')}
UNION ALL
{_not_null_sql('sales_rejected', 'rejected')}
UNION ALL
{_not_null_sql('report_batches', 'report_batches')}
UNION ALL
{_not_null_sql('report_daily', 'report_daily')}
UNION ALL
{_not_null_sql('report_topk', 'report_topk')}""",
    "check_unique": f"""{SALES_FACT},
{RAW_STORES},
{DIM}
{_unique_sql('fact_sales', 'fact', checks.UNIQUE['fact_sales'])}
UNION ALL
{_unique_sql('dim_store', 'dim', checks.UNIQUE['dim_store'])}
UNION ALL
{_unique_sql('sales_valid', 'valid', ('store_token', 'transaction_id'))}""",
    "ingest_csv_roundtrip": f"""WITH {RAW_STORES}
SELECT store_group, store_token, store_name, batch_date FROM raw_stores""",
    "batch_reconciliation": f"""{SALES_FACT},
pb AS (
  SELECT batch_date, count(*) AS raw_rows,
         sum(CASE WHEN reject_reason IS NULL THEN 1 ELSE 0 END) AS valid_rows,
         sum(CASE WHEN reject_reason IS NOT NULL THEN 1 ELSE 0 END) AS rejected_rows
  FROM classified GROUP BY 1
),
fr AS (SELECT batch_date, count(*) AS fact_rows FROM fact GROUP BY 1)
SELECT pb.batch_date, CAST(raw_rows AS BIGINT) AS raw_rows, CAST(valid_rows AS BIGINT) AS valid_rows,
       CAST(rejected_rows AS BIGINT) AS rejected_rows, CAST(coalesce(fact_rows, 0) AS BIGINT) AS fact_rows,
       raw_rows = valid_rows + rejected_rows AS split_ok,
       CAST(raw_rows - coalesce(fact_rows, 0) - rejected_rows AS BIGINT) AS dedup_gap
FROM pb LEFT JOIN fr ON fr.batch_date = pb.batch_date""",
}
