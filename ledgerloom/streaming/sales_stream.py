"""Silver sales as a stream into the fact: latest-wins as a stateful aggregation, then the upsert.

The state is one row for each key and span of load stamps: the newest version received, by the
same total order as the batch job's. A watermark on ``load_ts`` lets go of spans that no row can
reach any more, so the state holds what arrived lately and not the history. Each micro-batch hands
on the versions that changed, and the shipped upsert merges them: it compares load stamps with what
the fact holds, so a replay, or a version that a span repeats, changes nothing.

Load stamps grow with each delivery, so no row comes behind the watermark unless the files of an old
silver run are copied in by hand. Such a row is dropped here; the next batch run merges it, as
the stream marks no silver run as merged.

A stateful stream turns adaptive execution off for its session. The upsert of a micro-batch is a batch
job like any other, so it runs with the caller's setting: else each task would write a file into
every month or day that it meets, and no join or shuffle would be sized by what it holds.

The state is kept by RocksDB unless the session names another store (``STATE``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import merge
from ledgerloom.plans import daily_run

VALID_SCHEMA = (
    "store_token string, transaction_id string, receipt_token string, transaction_time timestamp_ntz, amount decimal(11,2), "
    "user_role string, file_name string, load_ts timestamp_ntz, src_block long, src_line long, silver_run string, batch_date date"
)
# The total order of versions, newest last: struct comparison puts nulls first, as the batch order does.
VERSION_ORDER = ("load_ts", "file_name", "src_block", "src_line", "amount", "receipt_token", "transaction_time", "user_role")


ADAPTIVE = "spark.sql.adaptive.enabled"
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: The state lies on the executors' disks, with a bounded part of it in memory: the versions of a large
#: delivery, all in the heap, leave no room for the work. Not used where the session names a store.
STATE = {
    STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings within this block."""
    was = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def adaptive_as(spark: SparkSession, setting: str):
    """Batch jobs of this block run with the given setting; the stream's own plans keep theirs."""
    return settings(spark, {ADAPTIVE: setting})


def latest_versions(rows: DataFrame, span: str, delay: str) -> DataFrame:
    """The newest version of each key within each span of load stamps, of a stream (or a table)."""
    rows = merge.fact_candidates(rows)
    # a watermark takes an instant: the stamps as the session's zone reads them, which keeps their order
    rows = rows.withColumn("stamp", F.col("load_ts").cast("timestamp")).withWatermark("stamp", delay)
    # the order holds the version itself but for its batch date, which comes last: the state keeps it once
    newest = F.max(F.struct(*VERSION_ORDER, "batch_date")).alias("v")
    out = rows.groupBy(*merge.FACT_KEYS, F.window("stamp", span)).agg(newest)
    return out.select(*merge.FACT_KEYS, "v.*")


def start_fact_stream(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    span: str = "1 day",
    delay: str = "1 day",
    fact_by: str = "day",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    reports_as_of: _dt.date | None = None,
) -> StreamingQuery:
    """Keep the fact, its totals and the key sketch up to date from ``silver/sales_valid``, as the one
    writer of gold. ``reports_as_of`` also rebuilds the reports after each micro-batch."""
    p = daily_run._paths(root)
    reader, setting = spark.readStream.schema(VALID_SCHEMA), spark.conf.get(ADAPTIVE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        # the state hands on a key once a span: there is nothing for a limit before the shuffle to drop
        with adaptive_as(batch.sparkSession, setting), settings(batch.sparkSession, {GROUP_LIMIT: "-1"}):
            daily_run.upsert_fact(batch.sparkSession, p, batch, fact_by)
            if reports_as_of is not None:
                daily_run.build_reports(batch.sparkSession, p, reports_as_of, daily_run.LIMITS)

    writer = latest_versions(reader.parquet(p["sales_valid"]), span, delay).writeStream.outputMode("update")
    writer = writer.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    named = spark.conf.get(STATE_STORE, None) is not None
    # the query takes a copy of the session's settings as it starts; one that goes on keeps its checkpoint's store
    with settings(spark, {} if named else STATE):
        return writer.start()
