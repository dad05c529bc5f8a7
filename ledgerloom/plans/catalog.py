"""Registered queries: every operator run over the driver's whole tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. The raw feeds are the projections in
``ledgerloom.sources.adapters``; ``ledgerloom.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import (
    SALES_COLUMNS,
    STORE_COLUMNS,
    cents_to_total,
    clean_amount,
    null_if_token,
    parse_transaction_time,
)
from ledgerloom.operators import checks, distinct, merge, quality, reports
from ledgerloom.operators.dedup import last_n_values
from ledgerloom.session import scratch_path, shared_dir
from ledgerloom.sources import adapters, csv_inbox, tables
from ledgerloom.sources.adapters import read_table

# --- fixed values of the query catalogue (shared with the oracle SQL) ---
SNAPSHOT_DATE = _dt.date(2025, 1, 1)
# Two sales deliveries for the incremental merge: batch dates before / from this day.
MERGE_CUTOFF = _dt.date(2000, 1, 1)
# Files of batch dates older than (latest batch date - this many days) are already logged.
LOGGED_BEFORE_DAYS = 30
PRIOR_LOG_TS = _dt.datetime(2024, 12, 30, 3, 0)
RUN_LOG_TS = _dt.datetime(2024, 12, 31, 3, 0)
# CSV deliveries made of lineitem: days, files of each, run time, and which lines are quoted, short, long.
DELIVERY_DAYS = (_dt.date(2024, 1, 1), _dt.date(2024, 1, 2))
DELIVERY_FILES = 4
RUN_TIME = _dt.time(3, 0)
QUOTED_MOD, SHORT_MOD, LONG_MOD = 79, 71, 73
# Files of the second inbox of the content gate: whose lines, under which name.
CONTENT_FILES = (("{d1}_0", "sales_20240105_0"), ("{d1}_1", "sales_20240105_1"), ("{d2}_2", "{d1}_2"), ("{d1}_3", "{d1}_3"), ("{d2}_0", "{d2}_0"))
# A record whose quoted field has no end, and the trailing window of the distinct counts.
OPEN_LINE = 'left,"open'
TRAILING_DAYS = 7
# --- end of fixed values ---

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ building blocks


def _raw(spark, sf_dir):
    return adapters.sales_raw_of(spark, sf_dir)


def _valid(spark, sf_dir):
    return quality.sales_valid(_raw(spark, sf_dir))


def _rejected(spark, sf_dir):
    return quality.sales_rejected(_raw(spark, sf_dir))


def _fact(spark, sf_dir):
    return merge.build_fact(_valid(spark, sf_dir))


def _stored_fact(spark, sf_dir):
    """The fact as the reports see it in the daily run: written once, then read.

    ``checkpoint()`` writes it to the session's shared checkpoint folder and cuts the
    lineage, so a report's date lookup and its main plan do not each rebuild the fact.
    """
    shared_dir(spark)
    return _fact(spark, sf_dir).checkpoint(eager=True)


def _fact_batch1(spark, sf_dir):
    return merge.build_fact(_valid(spark, sf_dir).where(F.col("batch_date") < F.lit(MERGE_CUTOFF)))


def _stores_clean(spark, sf_dir, versions=(1, 2)):
    return quality.clean_stores(adapters.stores_raw_of(spark, sf_dir, versions))


def _dim_v1(spark, sf_dir):
    return merge.scd2_initial(_stores_clean(spark, sf_dir, (1,)))


def _dim(spark, sf_dir):
    return merge.scd2_apply(_dim_v1(spark, sf_dir), _stores_clean(spark, sf_dir))


def _manifest(spark, sf_dir):
    """The shipped manifest of the feed's files, with the row count that ingestion would log."""
    counts = _raw(spark, sf_dir).groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count"))
    names = sorted(r.file_name for r in counts.select("file_name").collect())  # one row per file
    return csv_inbox.manifest(spark, names, RUN_LOG_TS).join(counts, "file_name").drop("path")


def _prior_log(manifest: DataFrame) -> DataFrame:
    """Log of an earlier run over the files of batch dates older than the recent window."""
    cutoff = manifest.agg(F.date_sub(F.max("batch_date"), LOGGED_BEFORE_DAYS).alias("cutoff"))
    old = manifest.join(F.broadcast(cutoff), F.col("batch_date") <= F.col("cutoff"), "left_semi")  # one row
    return csv_inbox.log_rows(old, PRIOR_LOG_TS)


# ------------------------------------------------------------------ queries


def q_amount_clean(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select("store_token", "transaction_id", "load_ts", F.col("amount").alias("amount_raw"),
                    clean_amount("amount").alias("amount"))


def q_timestamp_parse(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select("store_token", "transaction_id", "load_ts", F.col("transaction_time").alias("transaction_time_raw"),
                    parse_transaction_time("transaction_time").alias("transaction_time"))


def q_null_tokens(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    pk = li.l_partkey % 11
    raw_field = (
        F.when(pk == 0, F.lit("NULL")).when(pk == 1, F.lit("null")).when(pk == 2, F.lit(""))
        .when(pk == 3, F.lit("Null")).when(pk == 4, F.lit("   "))
        .otherwise(F.concat(F.lit("  "), li.l_returnflag, li.l_linestatus, F.lit(" ")))
    )
    return li.select("l_orderkey", "l_linenumber", raw_field.alias("raw_field")).withColumn(
        "value", null_if_token("raw_field"))


def q_sales_valid(spark, sf_dir):
    return _valid(spark, sf_dir)


def q_sales_rejected(spark, sf_dir):
    return _rejected(spark, sf_dir)


def q_reject_reason_counts(spark, sf_dir):
    return quality.reject_reason_counts(_rejected(spark, sf_dir))


def q_stores_clean(spark, sf_dir):
    return _stores_clean(spark, sf_dir)


def q_fact_dedup(spark, sf_dir):
    return _fact(spark, sf_dir)


def _stored_fact_batch1(spark, sf_dir):
    """The first delivery's fact, written once (as the daily run would have stored it)."""
    shared_dir(spark)
    return _fact_batch1(spark, sf_dir).checkpoint(eager=True)


def q_fact_merge_two_batches(spark, sf_dir):
    return merge.build_fact(_valid(spark, sf_dir), _stored_fact_batch1(spark, sf_dir))


def q_high_water_slice(spark, sf_dir):
    mark = merge.high_water_mark(_fact_batch1(spark, sf_dir), "last_load_ts")
    return merge.incremental_slice(_valid(spark, sf_dir), mark)


def q_scalar_max_default(spark, sf_dir):
    valid = _valid(spark, sf_dir)
    newest = merge.high_water_mark_df(valid, "load_ts")
    nothing_newer = valid.join(F.broadcast(newest), F.col("load_ts") > F.col("mark"), "left_semi")
    marks = [
        ("sales_valid", newest),
        ("fact_sales_batch1", merge.high_water_mark_df(_fact_batch1(spark, sf_dir), "last_load_ts")),
        ("stores_clean", merge.high_water_mark_df(_stores_clean(spark, sf_dir), "load_ts")),
        ("empty_slice", merge.high_water_mark_df(nothing_newer, "load_ts")),
    ]
    out = None
    for name, m in marks:
        part = m.select(F.lit(name).alias("table_name"), "mark")
        out = part if out is None else out.unionByName(part)
    return out


def q_dim_scd2_initial(spark, sf_dir):
    return _dim_v1(spark, sf_dir)


def q_dim_changes(spark, sf_dir):
    ch = merge.scd2_changes(_dim_v1(spark, sf_dir), _stores_clean(spark, sf_dir))
    return ch.select("store_token", "change_status")


def q_dim_scd2_apply(spark, sf_dir):
    return _dim(spark, sf_dir)


def q_dim_current(spark, sf_dir):
    return merge.dim_current(_dim(spark, sf_dir))


def q_report_batches(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    parsed = quality.parse_sales(raw)
    fact = merge.build_fact(quality.valid_from_parsed(parsed))
    return reports.report_batches(raw, fact, quality.rejected_from_parsed(parsed), snapshot_date=SNAPSHOT_DATE)


def q_report_daily(spark, sf_dir):
    return reports.report_daily(_stored_fact(spark, sf_dir), snapshot_date=SNAPSHOT_DATE)


def q_mtd_running_total(spark, sf_dir):
    daily = reports.month_to_date(reports.daily_summary(reports.daily_store_totals(_fact(spark, sf_dir))))
    return daily.select("transaction_date", cents_to_total("day_cents").alias("total_sales_amount"),
                        cents_to_total("mtd_cents").alias("month_accumulated_sales"))


def q_top_store_per_day(spark, sf_dir):
    return reports.top_store(reports.daily_store_totals(_fact(spark, sf_dir)))


def q_last_n_dates(spark, sf_dir):
    return last_n_values(reports.sales_by_day(_fact(spark, sf_dir)), "transaction_date", reports.DAILY_DATES)


def q_report_topk(spark, sf_dir):
    return reports.report_topk(_stored_fact(spark, sf_dir), _dim(spark, sf_dir), snapshot_date=SNAPSHOT_DATE)


def q_file_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)  # file_name, file_type, batch_date, file_order, load_ts, row_count


def q_pending_files(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return csv_inbox.pending(m, _prior_log(m)).select("file_type", "batch_date", "file_name", "row_count")


def q_ingestion_log(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    prior = _prior_log(m)
    return prior.unionByName(csv_inbox.log_rows(csv_inbox.pending(m, prior), RUN_LOG_TS))


def q_check_not_null(spark, sf_dir):
    fact = _stored_fact(spark, sf_dir)
    dim = _dim(spark, sf_dir)
    rows = [
        checks.not_null_failures(fact, "fact_sales", checks.NOT_NULL["fact_sales"]),
        checks.not_null_failures(dim, "dim_store", checks.NOT_NULL["dim_store"]),
        checks.not_null_failures(_rejected(spark, sf_dir), "sales_rejected", checks.NOT_NULL["sales_rejected"]),
        checks.not_null_failures(
            reports.report_batches(_raw(spark, sf_dir), fact, _rejected(spark, sf_dir), snapshot_date=SNAPSHOT_DATE),
            "report_batches", checks.NOT_NULL["report_batches"]),
        checks.not_null_failures(reports.report_daily(fact, snapshot_date=SNAPSHOT_DATE), "report_daily",
                                 checks.NOT_NULL["report_daily"]),
        checks.not_null_failures(reports.report_topk(fact, dim, snapshot_date=SNAPSHOT_DATE), "report_topk",
                                 checks.NOT_NULL["report_topk"]),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def q_check_unique(spark, sf_dir):
    return checks.unique_failures(_fact(spark, sf_dir), "fact_sales", checks.UNIQUE["fact_sales"]).unionByName(
        checks.unique_failures(_dim(spark, sf_dir), "dim_store", checks.UNIQUE["dim_store"])
    ).unionByName(
        # the raw feed repeats keys (natural duplicates): the check must see them
        checks.unique_failures(_valid(spark, sf_dir), "sales_valid", ("store_token", "transaction_id"))
    )


def q_batch_reconciliation(spark, sf_dir):
    """Per batch date: raw = valid + rejected exactly, and raw - fact - rejected >= 0."""
    raw = _raw(spark, sf_dir)
    parsed = quality.parse_sales(raw)
    per_batch = parsed.groupBy("batch_date").agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.sum(F.col("reject_reason").isNull().cast("long")).alias("valid_rows"),
        F.sum(F.col("reject_reason").isNotNull().cast("long")).alias("rejected_rows"),
    )
    fact = merge.build_fact(quality.valid_from_parsed(parsed))
    fact_rows = fact.groupBy("batch_date").agg(F.count(F.lit(1)).alias("fact_rows"))
    out = per_batch.join(fact_rows, "batch_date", "left").fillna(0, ["fact_rows"])
    return out.select(
        "batch_date",
        F.col("raw_rows").cast("long").alias("raw_rows"),
        F.col("valid_rows").cast("long").alias("valid_rows"),
        F.col("rejected_rows").cast("long").alias("rejected_rows"),
        F.col("fact_rows").cast("long").alias("fact_rows"),
        (F.col("raw_rows") == F.col("valid_rows") + F.col("rejected_rows")).alias("split_ok"),
        (F.col("raw_rows") - F.col("fact_rows") - F.col("rejected_rows")).cast("long").alias("dedup_gap"),
    )


def write_deliveries(
    spark: SparkSession,
    deliveries: dict[str, DataFrame],
    inbox: str,
    header: dict[str, bool],
    files: int | None = None,
) -> str:
    """Write each delivery as CSV files named ``<prefix>_<n>.csv`` into ``inbox``.

    Spark writes each delivery in parallel (one file per task, ``files`` tasks when
    given); the part files are then renamed into the inbox, a metadata-only step.
    """
    for prefix, df in deliveries.items():
        out = f"{inbox}/_write_{prefix}"
        if files:
            df = df.repartition(files)
        (
            df.write.option("header", str(header.get(prefix, False)).lower())
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .option("nullValue", "")
            .csv(out)
        )
        for i, part in enumerate(tables.list_files(spark, out, ".csv")):
            tables.move(spark, part, f"{inbox}/{prefix}_{i:05d}.csv")
    return inbox


PLACE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag"]


def sales_files(lineitem: DataFrame, breaks: bool = False) -> DataFrame:
    """``lineitem`` as lines of CSV deliveries: ``(file, place, line)``; ``line`` is null where ``sales_lines``
    makes it out of the place, so that the rows are sorted before they are spelled out.

    Two days of DELIVERY_FILES files each; the first file of a day has a header. With ``breaks``
    each file ends with a quoted field that has no end.
    """
    order = PLACE_COLUMNS
    day = F.when(F.col("l_shipdate") < F.lit(MERGE_CUTOFF), F.lit(DELIVERY_DAYS[0])).otherwise(F.lit(DELIVERY_DAYS[1]))
    number = (F.col("l_orderkey") % DELIVERY_FILES).cast("string")
    file = F.concat(F.lit("sales_"), F.date_format(day, "yyyyMMdd"), F.lit("_"), number)
    lines = lineitem.select(file.alias("file"), F.struct(F.lit(1).alias("body"), *order).alias("place"), F.lit(None).cast("string").alias("line"))
    heads = lines.select("file").distinct().where(F.col("file").endswith("_0"))
    none = [F.lit(None).cast(lines.schema["place"].dataType[c].dataType).alias(c) for c in order]
    head, tail = (F.struct(F.lit(body).alias("body"), *none) for body in (0, 2))
    out = lines.unionByName(heads.select("file", head.alias("place"), F.lit(",".join(SALES_COLUMNS)).alias("line")))
    if breaks:
        out = out.unionByName(lines.select("file").distinct().select("file", tail.alias("place"), F.lit(OPEN_LINE).alias("line")))
    return out


def sales_lines(rows: DataFrame, breaks: bool = False) -> DataFrame:
    """Rows of ``sales_files`` with all their lines: quoted, short, long, and with NULL spelled in two
    ways. With ``breaks`` the quoted fields hold a line break."""
    wide = adapters.raw_sales(rows.select("file", "line", "place.*"), keep=["file", "line", "l_partkey"])
    pk = F.col("l_partkey")
    null = F.when(pk % 2 == 0, F.lit("NULL")).otherwise(F.lit(""))
    told = [F.coalesce(F.col(c), null) for c in SALES_COLUMNS]
    role = F.when(pk % QUOTED_MOD == 0, F.concat(F.lit('"'), told[5], F.lit(',\n x"' if breaks else ', x"'))).otherwise(told[5])
    line = (
        F.when(pk % SHORT_MOD == 0, F.concat_ws(",", *told[:4]))
        .when(pk % LONG_MOD == 0, F.concat_ws(",", *told[:5], role, F.lit("more"), F.lit("more")))
        .otherwise(F.concat_ws(",", *[F.concat(F.lit(" "), t) for t in told[:4]], told[4], role))
    )
    return wide.select("file", F.coalesce("line", line).alias("line"))


def write_files(spark: SparkSession, lines: DataFrame, inbox: str, told: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> str:
    """Each ``file`` of ``lines`` as ``<file>.csv`` in ``inbox``, its lines in order of place; ``told``
    makes the lines of the ordered rows. A file that more than one task has written is a folder of
    that name, with its parts numbered in order."""
    out = f"{inbox}/_write_lines"
    ordered = told(lines.repartitionByRange("file", "place").sortWithinPartitions("file", "place"))
    ordered.select("line", "file").write.partitionBy("file").text(out)
    for name in tables.partition_values(spark, out, "file"):
        parts = tables.list_files(spark, f"{out}/file={name}", ".txt")
        if len(parts) == 1:
            tables.move(spark, parts[0], f"{inbox}/{name}.csv")
            continue
        for i, part in enumerate(parts):
            tables.move(spark, part, f"{out}/{name}.csv/{name}.{i:05d}.csv")
        tables.move(spark, f"{out}/{name}.csv", f"{inbox}/{name}.csv")
    return inbox


def _store_deliveries(spark, sf_dir):
    sup = read_table(spark, sf_dir, "supplier")
    v1 = adapters.raw_stores(sup, (1,)).select(*STORE_COLUMNS)
    v2 = adapters.raw_stores(sup, (2,)).select(
        F.concat(F.lit(" "), "store_group").alias("store_group"),
        "store_token",
        F.coalesce(F.concat(F.lit("  "), "store_name", F.lit(" ")), F.lit("NULL")).alias("store_name"),
    )
    return v1, v2


def q_ingest_csv_roundtrip(spark, sf_dir):
    """Supplier deliveries written as CSV (one with a header, one padded and with NULL
    tokens), ingested, and read back from bronze."""
    v1, v2 = _store_deliveries(spark, sf_dir)
    root = scratch_path(spark, "csv-roundtrip")
    inbox = write_deliveries(
        spark,
        {f"stores_{adapters.STORES_V1_DATE:%Y%m%d}": v1, f"stores_{adapters.STORES_V2_DATE:%Y%m%d}": v2},
        f"{root}/inbox",
        {f"stores_{adapters.STORES_V1_DATE:%Y%m%d}": True},
    )
    csv_inbox.ingest(spark, inbox, f"{root}/bronze", run_ts=RUN_LOG_TS)
    return csv_inbox.bronze(spark, f"{root}/bronze", "stores").select(*STORE_COLUMNS, "batch_date")


def q_ingest_sales_roundtrip(spark, sf_dir):
    """``lineitem`` through CSV files into bronze: every column but the record positions."""
    root = scratch_path(spark, "sales-roundtrip")
    inbox = write_files(spark, sales_files(read_table(spark, sf_dir, "lineitem")), f"{root}/inbox", sales_lines)
    csv_inbox.ingest(spark, inbox, f"{root}/bronze", run_ts=RUN_LOG_TS)
    return csv_inbox.bronze(spark, f"{root}/bronze", "sales").select(*SALES_COLUMNS, "batch_date", "file_name", "load_ts")


def q_ingest_summary(spark, sf_dir):
    """The summaries of loading the same files twice, and what the log holds afterwards."""
    root = scratch_path(spark, "sales-summary")
    inbox = write_files(spark, sales_files(read_table(spark, sf_dir, "lineitem")), f"{root}/inbox", sales_lines)
    first = csv_inbox.ingest(spark, inbox, f"{root}/bronze", run_ts=RUN_LOG_TS).summary
    second = csv_inbox.ingest(spark, inbox, f"{root}/bronze", run_ts=RUN_LOG_TS).summary
    log = spark.read.parquet(f"{root}/bronze/ingestion_log").withColumn("reason", F.lit(None).cast("string"))
    out = None
    for name, df in (("first", first), ("second", second), ("log", log)):
        part = df.select(F.lit(name).alias("step"), "file_name", "file_type", "batch_date", "status", "reason", "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def _two_daily_runs(spark, sf_dir, name: str, **options) -> str:
    """A daily run for each of the two deliveries; their root folder (tables below ``wh``)."""
    from ledgerloom.plans import daily_run

    root = scratch_path(spark, name)
    lines = sales_files(read_table(spark, sf_dir, "lineitem"))
    for day, stores in zip(DELIVERY_DAYS, _store_deliveries(spark, sf_dir)):
        prefix = f"{day:%Y%m%d}"
        inbox = write_files(spark, lines.where(F.col("file").startswith(f"sales_{prefix}")), f"{root}/in{prefix}", sales_lines)
        write_deliveries(spark, {f"stores_{prefix}": stores}, inbox, {}, files=1)
        if "archive_dir" in options:
            options["archive_dir"] = f"{root}/archive"
        daily_run.run_daily(spark, inbox, f"{root}/wh", run_ts=_dt.datetime.combine(day, RUN_TIME), snapshot_date=SNAPSHOT_DATE, **options)
    return root


def q_daily_run_outputs(spark, sf_dir):
    """Two daily runs with the fact by day; then what leaves them, ``(output, place, k, v)``: the
    reports in the order in which they are read, the same out of the exported CSV files, and the
    archived sales files with their lines."""
    from ledgerloom.plans import daily_run

    root = _two_daily_runs(spark, sf_dir, "outputs", archive_dir=True)
    keys = {"report_batches": "batch_date", "report_daily": "transaction_date", "report_topk": "transaction_date"}
    values = {
        "report_batches": ["total_processed_raw", "total_valid", "total_invalid"],
        "report_daily": ["total_sales_amount", "top_store_token"],
        "report_topk": ["top_rank_id", "store_total_sales", "store_token", "store_name"],
    }
    daily_run.export_reports_csv(spark, f"{root}/wh", f"{root}/out")
    out = []
    for name, key in keys.items():
        read = {"read": daily_run.read_report(spark, f"{root}/wh", name), "csv": spark.read.option("header", "true").csv(f"{root}/out/{name}")}
        for how, df in read.items():
            # a report has a few dozen rows: they are fetched in the order in which they come
            for place, r in enumerate(df.select(key, *values[name]).collect(), 1):
                out.append((f"{how}:{name}", place, str(r[0]), "|".join("-" if x is None else str(x) for x in r[1:])))
    rows = spark.createDataFrame(out, "output string, place long, k string, v string")
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "sales_*.csv").text(f"{root}/archive")
    where = F.regexp_extract(F.col("_metadata.file_path"), r"archive/(.*?\.csv)", 1)
    files = lines.groupBy(where.alias("k")).agg(F.count(F.lit(1)).cast("string").alias("v"))
    return rows.unionByName(files.select(F.lit("archive").alias("output"), F.lit(0).cast("long").alias("place"), "k", "v"))


def q_sales_stream_fact(spark, sf_dir):
    """The two deliveries as files of silver, a few at a time through the stream, into the fact."""
    from ledgerloom.plans import daily_run
    from ledgerloom.streaming import sales_stream

    root = scratch_path(spark, "stream")
    p = daily_run._paths(f"{root}/wh")
    lines = sales_files(read_table(spark, sf_dir, "lineitem"))
    for day in DELIVERY_DAYS:
        inbox = write_files(spark, lines.where(F.col("file").startswith(f"sales_{day:%Y%m%d}")), f"{root}/in{day:%Y%m%d}", sales_lines)
        csv_inbox.ingest(spark, inbox, p["bronze"], run_ts=_dt.datetime.combine(day, RUN_TIME))
        daily_run.build_silver(spark, p)
        sales_stream.start_fact_stream(spark, f"{root}/wh", f"{root}/ck", fact_by="month").awaitTermination()
    fact = daily_run.read_table(spark, f"{root}/wh", "fact_sales")
    return fact.select("store_token", "transaction_id", "transaction_time", "amount", "batch_date")


def q_ingest_quoted_breaks(spark, sf_dir):
    """``lineitem`` through CSV files with quoted line breaks into bronze."""
    root = scratch_path(spark, "quoted")
    inbox = write_files(spark, sales_files(read_table(spark, sf_dir, "lineitem"), breaks=True), f"{root}/inbox", partial(sales_lines, breaks=True))
    csv_inbox.ingest(spark, inbox, f"{root}/bronze", run_ts=RUN_LOG_TS)
    return csv_inbox.bronze(spark, f"{root}/bronze", "sales").select(*SALES_COLUMNS, "batch_date", "file_name", "load_ts")


def q_ingest_errors(spark, sf_dir):
    """The malformed records of the same files: one in each, the last."""
    root = scratch_path(spark, "errors")
    inbox = write_files(spark, sales_files(read_table(spark, sf_dir, "lineitem"), breaks=True), f"{root}/inbox", partial(sales_lines, breaks=True))
    csv_inbox.ingest(spark, inbox, f"{root}/bronze", run_ts=RUN_LOG_TS)
    return csv_inbox.ingestion_errors(spark, f"{root}/bronze").select("file_type", "batch_date", "file_name", "n_lines", "reason", "text")


def q_ingest_content_gate(spark, sf_dir):
    """The first day's files, then an inbox of renamed copies, one file again, one of the same name
    with other content, and a new one: the second summary."""
    root = scratch_path(spark, "content")
    lines = sales_files(read_table(spark, sf_dir, "lineitem"))
    d1, d2 = (f"sales_{d:%Y%m%d}" for d in DELIVERY_DAYS)
    csv_inbox.ingest(spark, write_files(spark, lines.where(F.col("file").startswith(d1)), f"{root}/in1", sales_lines), f"{root}/bronze",
                     run_ts=RUN_LOG_TS, by_content=True)
    again = None
    for source, name in CONTENT_FILES:
        part = lines.where(F.col("file") == source.format(d1=d1, d2=d2)).withColumn("file", F.lit(name.format(d1=d1, d2=d2)))
        again = part if again is None else again.unionByName(part)
    return csv_inbox.ingest(spark, write_files(spark, again, f"{root}/in2", sales_lines), f"{root}/bronze", by_content=True).summary


def q_dim_scd2_any_order(spark, sf_dir):
    """The dimension of both store deliveries, the second one delivered first."""
    late = _stores_clean(spark, sf_dir, (1,))
    dim = merge.scd2_splice(None, _stores_clean(spark, sf_dir, (2,)), _stores_clean(spark, sf_dir, (2,)))
    return merge.scd2_splice(dim, late, _stores_clean(spark, sf_dir))


def q_distinct_stores_by_window(spark, sf_dir):
    """Stores with sales per day, per month and per trailing week, from one set of day bitmaps."""
    totals = reports.daily_store_totals(_stored_fact(spark, sf_dir))
    known = totals.join(distinct.numbered(totals, "store_token"), "store_token")
    shared_dir(spark)
    maps = distinct.bitmaps(known, ["transaction_date"]).checkpoint(eager=True)
    days = maps.select("transaction_date").distinct()
    week = distinct.trailing(maps, "transaction_date", TRAILING_DAYS).join(days, "transaction_date", "left_semi")
    month = F.trunc("transaction_date", "month").alias("period")
    parts = [("day", maps, F.col("transaction_date").alias("period")), ("month", maps, month), ("week", week, F.col("transaction_date").alias("period"))]
    out = None
    for name, rows, key in parts:
        part = distinct.counts(rows, [key], "stores").select(F.lit(name).alias("kind"), "period", "stores")
        out = part if out is None else out.unionByName(part)
    return out


def q_daily_run_two_deliveries(spark, sf_dir):
    """Two daily runs over CSV deliveries; then fact (by day), dimension and reports, one row
    ``(table_name, k, v)`` for each of theirs."""
    from ledgerloom.plans import daily_run

    root = _two_daily_runs(spark, sf_dir, "daily", fact_by="month")  # lineitem has few rows a day
    t = daily_run.read_tables(spark, f"{root}/wh", ("fact_sales", "dim_store", *daily_run.REPORT_ORDER))
    text = lambda *cols: F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in cols])
    day = F.col("transaction_time").cast("date").alias("transaction_date")
    by_day = t["fact_sales"].groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    dim, c = t["dim_store"], F.col
    stamp = lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSS")
    parts = [
        ("fact_sales", by_day, text(c("transaction_date")), text(c("n"), c("total"))),
        ("dim_store", dim, text(c("dim_store_key")),
         text(c("store_token"), c("store_group"), c("store_name"), stamp("valid_from"), stamp("valid_to"), c("is_current"), stamp("first_seen_ts"))),
        ("report_batches", t["report_batches"], text(c("batch_date")),
         text(c("snapshot_date"), c("total_processed_raw"), c("total_valid"), c("total_invalid"), c("processing_date"))),
        ("report_daily", t["report_daily"], text(c("transaction_date")),
         text(c("stores_with_tx"), c("total_sales_amount"), c("total_sales_avg"), c("month_accumulated_sales"), c("top_store_token"))),
        ("report_topk", t["report_topk"], text(c("transaction_date"), c("top_rank_id")),
         text(c("store_total_sales"), c("store_token"), c("store_name"))),
    ]
    out = None
    for name, df, k, v in parts:
        part = df.select(F.lit(name).alias("table_name"), k.alias("k"), v.alias("v"))
        out = part if out is None else out.unionByName(part)
    return out


QUERIES: dict[str, Query] = {
    "amount_clean": q_amount_clean,
    "timestamp_parse": q_timestamp_parse,
    "null_tokens": q_null_tokens,
    "sales_valid": q_sales_valid,
    "sales_rejected": q_sales_rejected,
    "reject_reason_counts": q_reject_reason_counts,
    "stores_clean": q_stores_clean,
    "fact_dedup": q_fact_dedup,
    "fact_merge_two_batches": q_fact_merge_two_batches,
    "high_water_slice": q_high_water_slice,
    "scalar_max_default": q_scalar_max_default,
    "dim_scd2_initial": q_dim_scd2_initial,
    "dim_changes": q_dim_changes,
    "dim_scd2_apply": q_dim_scd2_apply,
    "dim_current": q_dim_current,
    "report_batches": q_report_batches,
    "report_daily": q_report_daily,
    "mtd_running_total": q_mtd_running_total,
    "top_store_per_day": q_top_store_per_day,
    "last_n_dates": q_last_n_dates,
    "report_topk": q_report_topk,
    "file_manifest": q_file_manifest,
    "pending_files": q_pending_files,
    "ingestion_log": q_ingestion_log,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "batch_reconciliation": q_batch_reconciliation,
    "ingest_csv_roundtrip": q_ingest_csv_roundtrip,
    "ingest_sales_roundtrip": q_ingest_sales_roundtrip,
    "ingest_summary": q_ingest_summary,
    "ingest_quoted_breaks": q_ingest_quoted_breaks,
    "ingest_errors": q_ingest_errors,
    "ingest_content_gate": q_ingest_content_gate,
    "dim_scd2_any_order": q_dim_scd2_any_order,
    "distinct_stores_by_window": q_distinct_stores_by_window,
    "daily_run_two_deliveries": q_daily_run_two_deliveries,
    "daily_run_outputs": q_daily_run_outputs,
    "sales_stream_fact": q_sales_stream_fact,
}
