"""The fact by stream against the fact by batch, over late, repeated and corrected records."""

import datetime as dt
import os
from decimal import Decimal

from fixtures import write_inbox
from ledgerloom.plans import daily_run
from ledgerloom.sources import csv_inbox, tables
from ledgerloom.streaming.sales_stream import VALID_SCHEMA, adaptive_as, latest_versions, start_fact_stream

SNAP = dt.date(2024, 12, 1)
DELIVERIES = [
    # t2 twice in a file: the later line wins
    "s1,t1,RCPT001,2024-03-01T10:00:00,$1.00,R\ns1,t2,RCPT002,2024-03-01T10:00:00,$2.00,R\ns1,t2,RCPT002,2024-03-01T10:00:00,$2.50,R\n",
    # t1 repeated as it was, t2 corrected to another day, a rejected row
    "s1,t1,RCPT001,2024-03-01T10:00:00,$1.00,R\ns1,t2,RCPT002,2024-03-04T10:00:00,$3.00,R\ns1,t9,x,bad,$1.00,R\n",
    # a late sale of an old day, and t1 corrected long after its first span
    "s2,t3,RCPT003,2024-02-01T10:00:00,$5.00,R\ns1,t1,RCPT001,2024-03-01T10:00:00,$9.00,\n",
    "s3,t4,RCPT004,2024-03-09T10:00:00,$4.00,R\n",
]


def _silver(spark, p, workdir, i):
    inbox = write_inbox(os.path.join(workdir, f"in{i}"), {f"sales_2024031{i}.csv": DELIVERIES[i]})
    csv_inbox.ingest(spark, inbox, p["bronze"], run_ts=dt.datetime(2024, 3, 10 + 3 * i, 3))
    daily_run.build_silver(spark, p)


def _facts(spark, root):
    return {n: sorted((tuple(r) for r in daily_run.read_table(spark, root, n).collect()), key=repr) for n in ("fact_sales", "day_totals", "batch_totals")}


def test_the_stream_ends_as_the_batch_run(spark, workdir):
    root, ck = os.path.join(workdir, "stream"), os.path.join(workdir, "ck")
    p = daily_run._paths(root)
    states = []
    for i in range(len(DELIVERIES)):
        _silver(spark, p, workdir, i)
        # each start is a restart from the checkpoint
        query = start_fact_stream(spark, root, ck, max_files_per_trigger=1, reports_as_of=SNAP)
        query.awaitTermination()
        done = [x for x in query.recentProgress if x["stateOperators"]]
        states.append(done[-1]["stateOperators"][0]["numRowsTotal"])
        assert all(x["stateOperators"][0]["numRowsDroppedByWatermark"] == 0 for x in done)
    other = os.path.join(workdir, "batch")
    for i in range(len(DELIVERIES)):
        inbox = os.path.join(workdir, f"in{i}")
        daily_run.run_daily(spark, inbox, other, run_ts=dt.datetime(2024, 3, 10 + 3 * i, 3), snapshot_date=SNAP)
    assert _facts(spark, root) == _facts(spark, other)
    for name in ("report_batches", "report_daily"):
        mine, theirs = (sorted(map(tuple, daily_run.read_table(spark, r, name).collect())) for r in (root, other))
        assert mine == theirs
    # deliveries are three days apart: the spans of old ones are let go, the state does not add up
    assert states[-1] <= 3 < sum(len(d.splitlines()) for d in DELIVERIES)


def test_a_batch_that_is_replayed_changes_nothing(spark, workdir):
    root = os.path.join(workdir, "wh")
    p = daily_run._paths(root)
    for i in (0, 1):
        _silver(spark, p, workdir, i)
        start_fact_stream(spark, root, os.path.join(workdir, "ck")).awaitTermination()
    before = _facts(spark, root)
    start_fact_stream(spark, root, os.path.join(workdir, "other-ck")).awaitTermination()  # all of it again
    assert _facts(spark, root) == before
    # and the batch run, which knows nothing of the stream, merges the same runs to no effect
    daily_run.build_gold(spark, p)
    assert _facts(spark, root) == before


def test_the_state_keeps_one_version_a_key_and_span(spark):
    rows = [("s", "t", "RCPT001", dt.datetime(2024, 3, 1), 1, "R", "f", dt.datetime(2024, 3, d, h), 0, n, "run", dt.date(2024, 3, 1))
            for d, h, n in ((1, 1, 0), (1, 1, 1), (1, 0, 9), (2, 0, 0))]
    from ledgerloom.streaming.sales_stream import VALID_SCHEMA

    from decimal import Decimal

    df = spark.createDataFrame([(*r[:4], Decimal(r[4]), *r[5:]) for r in rows], VALID_SCHEMA)
    got = sorted((r.load_ts, r.src_line) for r in latest_versions(df, "1 day", "1 day").collect())
    assert got == [(dt.datetime(2024, 3, 1, 1), 1), (dt.datetime(2024, 3, 2), 0)]


def test_the_upsert_of_a_micro_batch_runs_adaptively(spark, workdir, monkeypatch):
    """Each month is written as one file, not by every task; the stream's own setting comes back."""
    lines = [f"s{i % 7},t{i},RCPT{i:03d},2024-{1 + i % 6:02d}-{1 + i % 20:02d}T10:00:00,$1.00,R\n" for i in range(300)]
    monkeypatch.setitem(globals(), "DELIVERIES", ["".join(lines[:200]), "".join(lines[100:])])
    root, seen = os.path.join(workdir, "wh"), []
    p, upsert = daily_run._paths(root), daily_run.upsert_fact

    def told(session, *args):
        seen.append(session.conf.get("spark.sql.adaptive.enabled"))
        return upsert(session, *args)

    monkeypatch.setattr(daily_run, "upsert_fact", told)
    for i in (0, 1):
        _silver(spark, p, workdir, i)
        start_fact_stream(spark, root, os.path.join(workdir, "ck"), fact_by="month").awaitTermination()
    assert set(seen) == {spark.conf.get("spark.sql.adaptive.enabled")} == {"true"}
    for table in ("fact_sales", "day_totals"):
        files = [tables.list_files(spark, f"{p[table]}/transaction_month=2024-{m:02d}-01") for m in range(1, 7)]
        assert [len(f) for f in files] == [1] * 6
    assert daily_run.read_table(spark, root, "fact_sales").count() == 300
    with adaptive_as(spark, "false"):
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_versions_alike_but_for_the_batch_date_are_one(spark):
    """Rows with the same stamps and places: the later batch date, whatever the order in which they come."""
    rows = [("s", "t", "RCPT001", dt.datetime(2024, 3, 1), Decimal(1), None, "f", dt.datetime(2024, 3, 1), 0, 1, "run", dt.date(2024, 3, d)) for d in (2, 1)]
    for some in (rows, rows[::-1]):
        got = latest_versions(spark.createDataFrame(some, VALID_SCHEMA).coalesce(1), "1 day", "1 day").collect()
        assert [(r.batch_date, r.receipt_token, r.user_role) for r in got] == [(dt.date(2024, 3, 2), "RCPT001", None)]


def test_the_state_lies_outside_the_heap(spark, workdir):
    """RocksDB keeps the state, unless the session names a store; the session's settings stay as they were."""
    from ledgerloom.streaming import sales_stream as s

    def metrics(name):
        root = os.path.join(workdir, name)
        _silver(spark, daily_run._paths(root), root, 0)
        query = start_fact_stream(spark, root, os.path.join(root, "ck"))
        query.awaitTermination()
        return {m for x in query.recentProgress for o in x["stateOperators"] for m in o["customMetrics"]}

    assert any(m.startswith("rocksdb") for m in metrics("disk"))
    assert [spark.conf.get(k, None) for k in (*s.STATE, s.GROUP_LIMIT)] == [None] * 3
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with s.settings(spark, {s.STATE_STORE: heap}):
        told = metrics("heap")
    assert told and not any(m.startswith("rocksdb") for m in told)
