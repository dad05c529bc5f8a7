"""Plan-shape guards for the scale properties (checked on executed plans)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import merge, reports


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _fact(spark, n=5000):
    return spark.range(n).select(
        (F.col("id") % 40).cast("string").alias("store_token"),
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("RCPT01").alias("receipt_token"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 28 + 1).cast("int"), F.lit(9), F.lit(0), F.lit(0))
        .alias("transaction_time"),
        F.lit(2).cast("decimal(11,2)").alias("amount"),
        F.lit("r").alias("user_role"),
        F.lit(dt.date(2024, 1, 1)).alias("batch_date"),
        F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz").alias("last_load_ts"),
    )


def test_upsert_streams_target_through_a_broadcast_anti_join(spark):
    target = _fact(spark)
    updates = _fact(spark, 100)
    plan = _plan(merge.upsert(target, updates, merge.FACT_KEYS))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_a_large_update_is_shuffled_and_merges_alike(spark):
    """Beyond the broadcast limit both sides are shuffled by key; the rows are the same."""
    target, updates = _fact(spark), _fact(spark, 100).withColumn("amount", F.lit(9).cast("decimal(11,2)"))
    small = merge.upsert(target, updates, merge.FACT_KEYS)
    want = sorted(map(tuple, small.collect()))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = merge.upsert(target, updates, merge.FACT_KEYS)
        assert "SortMergeJoin" in _plan(large) and "Broadcast" not in _plan(large)
        assert sorted(map(tuple, large.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sum(r[4] == 9 for r in want) == 100 and len(want) == 5000


def test_report_daily_scans_the_fact_once_without_a_global_window(spark, tmp_path):
    path = str(tmp_path / "fact")
    _fact(spark).write.parquet(path)
    fact = spark.read.parquet(path)
    out = reports.report_daily(fact, n=10)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1  # one fact scan feeds every per-day figure
    assert "SinglePartition" not in final  # no unpartitioned window or global limit


def test_dedup_limits_before_the_shuffle(spark):
    plan = _plan(merge.dedup_sales(_fact(spark).withColumn("file_name", F.lit("f")).withColumnRenamed(
        "last_load_ts", "load_ts")))
    first_exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[first_exchange:]


def test_driver_tables_are_scanned_as_they_are(spark):
    from conftest import SF001
    from ledgerloom.plans.catalog import QUERIES

    for name in ("amount_clean", "sales_valid", "null_tokens"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert "InMemoryTableScan" not in plan and "RoundRobin" not in plan
        assert plan.count("FileScan parquet") == 1


def test_dimension_is_applied_in_one_pass(spark):
    from conftest import SF001
    from ledgerloom.plans.catalog import QUERIES

    df = QUERIES["dim_scd2_apply"](spark, SF001)
    # the dimension's rows, and the two deliveries
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 3


def test_reports_prune_the_fact_by_partition(spark, tmp_path):
    path = str(tmp_path / "fact")
    day = F.col("transaction_time").cast("date")
    _fact(spark).withColumn("transaction_date", day).write.partitionBy("transaction_date").parquet(path)
    fact = spark.read.parquet(path)
    days = [dt.date(2024, 1, d) for d in range(1, 29)]
    out = reports.report_topk(fact, spark.createDataFrame([], "store_token string, store_name string, is_current boolean"), 3, dates=days)
    scan = _plan(out).split("PartitionFilters: [")[1].split("]")[0]
    assert "transaction_date" in scan
    assert {r.transaction_date for r in out.collect()} == set(days[-3:])


def test_no_window_over_a_whole_table_in_the_log(spark):
    from conftest import SF001
    from ledgerloom.plans.catalog import QUERIES

    assert "Window" not in _plan(QUERIES["ingestion_log"](spark, SF001))


def test_a_sales_row_is_parsed_once_in_compiled_code(spark):
    """The reject filter stays above the parse, and no generated method is too large for the JIT."""
    import re

    from conftest import SF001
    from ledgerloom.plans.catalog import QUERIES

    for name in ("sales_valid", "sales_rejected"):
        execution = QUERIES[name](spark, SF001)._jdf.queryExecution()
        plan = execution.optimizedPlan().toString()
        assert plan.count("as timestamp_ntz) END") == 1 and plan.count("as decimal(11,2))") == plan.count("cast(l_extendedprice") + 1
        code = spark._jvm.PythonSQLUtils.explainString(execution, "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
        assert max(sizes, default=0) < 8000 and sizes
