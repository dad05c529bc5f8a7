"""Invariants over the registered queries on the driver tables (sf0.001)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from ledgerloom.plans.catalog import QUERIES


def test_dimension_intervals(spark):
    dim = QUERIES["dim_scd2_apply"](spark, SF001)
    # exactly one current row per store
    assert dim.where("is_current").groupBy("store_token").count().where("count <> 1").count() == 0
    assert dim.select("store_token").distinct().count() == dim.where("is_current").count()
    # closed rows end where the next version starts; intervals never overlap
    w = Window.partitionBy("store_token").orderBy("valid_from")
    nxt = dim.withColumn("next_from", F.lead("valid_from").over(w))
    assert nxt.where("next_from IS NOT NULL AND (valid_to IS NULL OR valid_to <> next_from)").count() == 0
    assert nxt.where("next_from IS NULL AND NOT is_current").count() == 0
    # a new version carries the store's first appearance
    first = dim.groupBy("store_token").agg(F.min("valid_from").alias("f"), F.countDistinct("first_seen_ts").alias("n"))
    assert first.where("n <> 1").count() == 0


def test_batch_reconciliation(spark):
    rec = QUERIES["batch_reconciliation"](spark, SF001)
    assert rec.where("NOT split_ok").count() == 0
    assert rec.where("dedup_gap < 0").count() == 0
    totals = rec.agg(F.sum("raw_rows").alias("raw"), F.sum("fact_rows").alias("fact")).first()
    fact = QUERIES["fact_dedup"](spark, SF001).count()
    assert totals.fact == fact and totals.raw == spark.read.parquet(f"{SF001}/lineitem.parquet").count()


def test_reject_counts_add_up(spark):
    counts = {r.reject_reason: r.n_rows for r in QUERIES["reject_reason_counts"](spark, SF001).collect()}
    rejected = QUERIES["sales_rejected"](spark, SF001).count()
    valid = QUERIES["sales_valid"](spark, SF001).count()
    assert sum(counts.values()) == rejected
    assert valid + rejected == spark.read.parquet(f"{SF001}/lineitem.parquet").count()
