"""Operators against brute-force Python models on random small inputs (hypothesis)."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import merge, reports

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.sampled_from(["a", "b", "c", "d", None])
rows_kv = st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12)


@SETTINGS
@given(rows_kv, rows_kv)
def test_upsert_matches_model(spark, target, updates):
    t = spark.createDataFrame(target, "k string, v int")
    u = spark.createDataFrame(updates, "k string, v int")
    got = sorted(map(tuple, merge.upsert(t, u, ["k"]).collect()), key=repr)
    upd_keys = {k for k, _ in updates if k is not None}
    want = [r for r in target if r[0] is None or r[0] not in upd_keys] + list(updates)
    assert got == sorted(want, key=repr)


sale = st.tuples(
    st.sampled_from(["s1", "s2", "s3"]),               # store
    st.sampled_from(["t1", "t2", "t3", "t4"]),         # transaction
    st.integers(0, 5),                                 # load hour
    st.sampled_from(["f1.csv", "f2.csv"]),             # file
    st.integers(1, 9999),                              # cents
    st.integers(1, 6),                                 # event day
)


def _fact_df(spark, rows):
    data = [(s, t, "RCPT01", dt.datetime(2024, 1, d, 12), Decimal(c) / 100, "r", dt.date(2024, 1, 1), f,
             dt.datetime(2024, 2, 1, h)) for s, t, h, f, c, d in rows]
    return spark.createDataFrame(
        data, "store_token string, transaction_id string, receipt_token string, transaction_time timestamp_ntz, "
              "amount decimal(11,2), user_role string, batch_date date, file_name string, load_ts timestamp_ntz")


@SETTINGS
@given(st.lists(sale, min_size=1, max_size=15))
def test_dedup_matches_model(spark, rows):
    got = {(r.store_token, r.transaction_id): (r.last_load_ts, r.amount)
           for r in merge.dedup_sales(_fact_df(spark, rows)).collect()}
    best = {}
    for s, t, h, f, c, d in rows:
        key = (h, f, c)  # load_ts, then file name, then amount (all descending)
        if (s, t) not in best or key > best[(s, t)]:
            best[(s, t)] = key
    want = {k: (dt.datetime(2024, 2, 1, v[0]), Decimal(v[2]) / 100) for k, v in best.items()}
    assert got == want


@SETTINGS
@given(st.lists(sale, min_size=1, max_size=15), st.integers(1, 4), st.integers(1, 3))
def test_daily_report_and_topk_match_model(spark, rows, n, k):
    fact = merge.dedup_sales(_fact_df(spark, rows))
    facts = [(r.store_token, r.transaction_time.date(), int(r.amount * 100)) for r in fact.collect()]
    days = sorted({d for _, d, _ in facts}, reverse=True)[:n]
    daily = {r.transaction_date: r for r in reports.report_daily(fact, n=n).collect()}
    assert sorted(daily, reverse=True) == days
    for d in days:
        per_store = {}
        for s, dd, c in facts:
            if dd == d:
                per_store[s] = per_store.get(s, 0) + c
        total = sum(per_store.values())
        count = sum(1 for _, dd, _ in facts if dd == d)
        mtd = sum(c for _, dd, c in facts if dd.month == d.month and dd <= d)
        top = sorted(per_store.items(), key=lambda x: (-x[1], x[0]))
        r = daily[d]
        assert r.stores_with_tx == len(per_store)
        assert r.total_sales_amount == Decimal(total) / 100
        assert r.month_accumulated_sales == Decimal(mtd) / 100
        assert r.top_store_token == top[0][0]
        assert r.total_sales_avg == (Decimal(total) / count / 100).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    dim = spark.createDataFrame([("s1", "One", True), ("s2", "Two", False)], "store_token string, store_name string, "
                                                                            "is_current boolean")
    topk = reports.report_topk(fact, dim, n=n, k=k).collect()
    want = []
    for d in days:
        per_store = {}
        for s, dd, c in facts:
            if dd == d:
                per_store[s] = per_store.get(s, 0) + c
        ranked = sorted(per_store.items(), key=lambda x: (-x[1], x[0]))[:k]
        want += [(d, i + 1, s, Decimal(c) / 100, "One" if s == "s1" else None) for i, (s, c) in enumerate(ranked)]
    assert [(r.transaction_date, r.top_rank_id, r.store_token, r.store_total_sales, r.store_name) for r in topk] == want
