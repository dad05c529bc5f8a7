"""Continuous ingestion: the inbox as a Structured Streaming file source.

The file source remembers which files it has handed out (in the checkpoint), so a
restarted or re-triggered query only sees new files. Each micro-batch goes through the
same path as the batch ingest: manifest of the batch's files, the LOADED-log gate,
header detection and positional parse, append to bronze, one log row per file.
``trigger(availableNow=True)`` turns it into a scheduled incremental job.

With ``archive_dir`` the file source itself moves files there, each once a later trigger has
committed the batch that read it.

A batch that fails before its log row leaves nothing visible and is loaded again when the
stream replays it; one that fails after it is skipped by the gate. Limits: the file source
does not list empty files, so they get no log row, and takes no files that come as folders of parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.sources import csv_inbox, tables


def _load_batch(bronze_root: str):
    def load(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        files = batch.select("file_name").distinct().where("file_name like 'stores!_%' escape '!' or file_name like 'sales!_%' escape '!'")
        names = sorted(r.file_name for r in files.collect())  # one row per file of the batch
        if not names:
            return

        def read(todo: DataFrame) -> DataFrame:
            names = [r[0] for r in todo.select("file_name").collect()]
            return csv_inbox.positioned(batch.where(F.col("file_name").isin(names)))

        log = tables.read_or_none(spark, f"{bronze_root}/ingestion_log")
        csv_inbox.load_files(spark, names, bronze_root, log, None, read)

    return load


def start_inbox_stream(
    spark: SparkSession,
    inbox: str,
    bronze_root: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Start the inbox stream; ``available_now`` drains what is there and stops."""
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    writer = csv_inbox.with_file_columns(reader.load(inbox)).writeStream.foreachBatch(_load_batch(bronze_root.rstrip("/"))).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
