import os

from fixtures import write_inbox
from ledgerloom.streaming.inbox_stream import start_inbox_stream


def test_inbox_stream_available_now(spark, workdir):
    inbox = write_inbox(os.path.join(workdir, "inbox"))
    bronze = os.path.join(workdir, "bronze")
    ck = os.path.join(workdir, "ck")
    start_inbox_stream(spark, inbox, bronze, ck).awaitTermination()
    sales = spark.read.parquet(os.path.join(bronze, "sales_raw"))
    assert sales.count() == 14
    # the header of the first file is dropped, the header-like line in the middle is kept
    assert sales.where("store_token = 'store_token'").count() == 1
    log = spark.read.parquet(os.path.join(bronze, "ingestion_log"))
    assert log.count() == 5  # the empty file is not handed out by the file source
    # a new file arrives: only it is processed
    write_inbox(inbox, {"sales_20241121.csv": "s9,t99,RCPT099,20241121T100000.000,$9.99,CASHIER\n"})
    start_inbox_stream(spark, inbox, bronze, ck).awaitTermination()
    assert spark.read.parquet(os.path.join(bronze, "sales_raw")).count() == 15
    assert spark.read.parquet(os.path.join(bronze, "ingestion_log")).count() == 6


def test_the_stream_archives_what_an_earlier_trigger_read(spark, workdir):
    inbox, bronze, ck, arch = (os.path.join(workdir, x) for x in ("inbox", "bronze", "ck", "archive"))
    names = [f"sales_2024112{i}.csv" for i in (1, 2, 3)]
    for i, name in enumerate(names):
        write_inbox(inbox, {name: f"s9,t{i},RCPT099,20241121T100000.000,$9.99,CASHIER\n"})
        start_inbox_stream(spark, inbox, bronze, ck, archive_dir=arch).awaitTermination()
    archived = {f for _, _, files in os.walk(arch) for f in files if not f.startswith(".")}
    assert names[0] in archived and names[0] not in os.listdir(inbox)
    assert set(names) <= archived | set(os.listdir(inbox))
    # the gate still holds: an archived file that comes back is not loaded again
    write_inbox(inbox, {names[0]: "s9,t0,RCPT099,20241121T100000.000,$1.00,CASHIER\n"})
    start_inbox_stream(spark, inbox, bronze, ck, archive_dir=arch).awaitTermination()
    assert spark.read.parquet(os.path.join(bronze, "sales_raw")).count() == 3
    assert spark.read.parquet(os.path.join(bronze, "ingestion_log")).count() == 3
