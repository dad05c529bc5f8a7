import datetime as dt
import itertools
import os

from fixtures import write_inbox
from ledgerloom.operators import merge
from ledgerloom.plans.daily_run import read_tables, run_daily

STORES = "store_token string, store_group string, store_name string, load_ts timestamp_ntz, file_name string"


def _day(d):
    return dt.datetime(2024, 1, d)


# s1 goes to B and back to A (the middle version is not missed when it comes last), s2 never changes, s3 comes late
DELIVERIES = [
    [("s1", "G", "A", _day(1), "f1"), ("s2", "G", "X", _day(1), "f1")],
    [("s1", "G", "B", _day(2), "f2"), ("s2", "G", "X", _day(2), "f2")],
    [("s1", "G", "A", _day(3), "f3"), ("s3", "G", "Z", _day(3), "f3")],
    [("s1", "H", "A", _day(4), "f4"), ("s2", "G", "X", _day(4), "f4")],
]


def _rows(df):
    return sorted((tuple(r) for r in df.select(*merge.DIM_COLUMNS).collect()), key=repr)


def test_any_order_of_deliveries_gives_one_dimension(spark):
    frames = [spark.createDataFrame(d, STORES) for d in DELIVERIES]
    in_order = None
    for f in frames:
        in_order = merge.scd2_apply(in_order, f)
        in_order = spark.createDataFrame(in_order.collect(), in_order.schema)
    want = _rows(in_order)
    assert len(want) == 6
    for order in list(itertools.permutations(range(4)))[::3]:  # each delivery comes first, and last
        dim, known = None, None
        for i in order:
            known = frames[i] if known is None else known.unionByName(frames[i])
            dim = merge.scd2_splice(dim, frames[i], known)
            dim = spark.createDataFrame(dim.collect(), dim.schema)
        assert _rows(dim) == want, order


def test_a_late_delivery_in_the_daily_run(spark, workdir):
    texts = {"stores_20240101.csv": "G,s1,A\n", "stores_20240102.csv": "G,s1,B\n", "stores_20240103.csv": "G,s1,A\n"}
    dims = {}
    for order in (("1", "2", "3"), ("3", "1", "2")):
        root = os.path.join(workdir, "".join(order))
        for i in order:
            inbox = write_inbox(os.path.join(root, f"in{i}"), {f"stores_2024010{i}.csv": texts[f"stores_2024010{i}.csv"]})
            run_daily(spark, inbox, os.path.join(root, "wh"), run_ts=_day(int(i)), late_stores=True)
        dims[order] = read_tables(spark, os.path.join(root, "wh"))["dim_store"]
    names = lambda df: [(r.store_name, r.is_current) for r in df.orderBy("valid_from").collect()]
    assert names(dims[("1", "2", "3")]) == [("A", False), ("B", False), ("A", True)]
    # a run's stamps never go back, so the late files are the newest versions: A, then A again, then B
    assert names(dims[("3", "1", "2")]) == [("A", False), ("B", True)]
