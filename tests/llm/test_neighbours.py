import duckdb
import numpy as np
import pytest
from helpers import clashing, rows
from pyspark.sql import functions as F

from conftest import SF01
from ledgerloom.llm import neighbours

ROWS = "vec_id long, vec array<float>"


def brute(data, asks, top):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in data if i is not None and v is not None and None not in v]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in ok:
        if asks(q):
            near = sorted(((-float(x @ v), i) for i, v in ok if i != q))[:top]
            out[q] = [(i, -s) for s, i in near]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(found, want):
    return sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in n}) for q, n in want.items()) / sum(map(len, want.values()))


def check_scores(found, data):
    vec = {i: np.array(v, np.float32).astype(float) for i, v in data}
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        for i, s in near:
            assert abs(float(vec[q] @ vec[i]) - s) < 1e-9


def test_embeddings_against_brute_force(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"))
    data = [(r.vec_id, r.vec) for r in table.collect()]
    found = got(neighbours.nearest(table, F.col("vec_id") % 20 == 0))
    want = brute(data, lambda i: i % 20 == 0, 20)
    assert found.keys() == want.keys() and all(len(n) == 20 for n in found.values())
    assert recall(found, want) >= 0.9
    check_scores(found, data)


def test_unequal_lengths_copies_and_noise(spark):
    """Inner products where norms differ, a third of all rows one vector, and no clusters."""
    rng = np.random.default_rng(2)
    wild = rng.normal(size=(600, 24)) * rng.lognormal(size=(600, 1))
    data = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(wild)]
    data += [(600 + i, data[7][1]) for i in range(300)]
    found = got(neighbours.nearest(spark.createDataFrame(data, ROWS), F.col("vec_id") % 20 == 0))
    want = brute(data, lambda i: i % 20 == 0, 20)
    assert recall(found, want) >= 0.9
    check_scores(found, data)
    assert [i for i, _ in found[620]] == [i for i, _ in want[620]]


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (None, [1.0, 1.0]),
            (60, [0.5, 0.5]), (60, [0.5, 0.5]), (4, [1.0, 0.0]), (5, [-1.0, 0.0]), (80, [])]
    table = spark.createDataFrame(data, ROWS)
    found = got(neighbours.nearest(clashing(table), F.col("vec_id") % 20 == 0))
    assert found == {0: [(4, 1.0), (60, 0.5), (5, -1.0)], 60: [(0, 0.5), (4, 0.5), (5, -0.5)]}
    assert rows(neighbours.nearest(table.limit(0), F.lit(True))) == []
    assert rows(neighbours.nearest(table.where("vec_id = 0"), F.lit(True))) == []


def test_brute_force_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    data = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 4)).astype(np.float32))]
    nodes = spark.createDataFrame(data, "id long, vec array<float>")
    found = neighbours.brute_force(nodes, nodes.select(F.col("id").alias("q")), 5).collect()
    near = {}
    for r in found:
        near.setdefault(r.q, set()).add(r.v)
    vec = np.array([v for _, v in data], float)
    assert near == {q: set(np.argsort(-(vec @ vec[q]))[:5].tolist()) for q in range(50)}


def dense(n, dims, spread, seed):
    """Vectors of length 1 without clusters but for a third of them around one centre, all unequal."""
    rng = np.random.default_rng(seed)
    wild = rng.normal(size=(n, dims))
    wild /= np.linalg.norm(wild, axis=1, keepdims=True)
    third = rng.permutation(n)[: n // 3]
    wild[third] = wild[third[0]] + rng.normal(size=(len(third), dims)) * spread
    return [(i, v) for i, v in enumerate(wild.astype(np.float32).tolist())], set(third.tolist())


def test_dense_group_of_unequal_vectors(spark):
    """A third of the rows so close together that a search by rounded vectors cannot order them."""
    data, third = dense(3000, 64, 0.0005, 4)
    found = got(neighbours.nearest(spark.createDataFrame(data, ROWS), F.col("vec_id") % 20 == 0))
    want = brute(data, lambda i: i % 20 == 0, 20)
    assert any(q in third for q in want) and not all(q in third for q in want)
    assert recall(found, want) == 1
    check_scores(found, data)


def test_vectors_in_nobodys_list(spark):
    """In a dense group many vectors are near neighbours of few others, which still find them."""
    data, _ = dense(600, 16, 0.0005, 5)
    found = got(neighbours.nearest(spark.createDataFrame(data, ROWS), F.lit(True), top=3))
    assert recall(found, brute(data, lambda i: True, 3)) == 1


def test_no_neighbour_is_lost_without_clusters(spark):
    rng = np.random.default_rng(6)
    flat = rng.normal(size=(6000, 64))
    flat /= np.linalg.norm(flat, axis=1, keepdims=True)
    data = [(i, v) for i, v in enumerate(flat.astype(np.float32).tolist())]
    found = got(neighbours.nearest(spark.createDataFrame(data, ROWS), F.col("vec_id") % 40 == 0))
    assert recall(found, brute(data, lambda i: i % 40 == 0, 20)) == 1


def test_copies_closer_than_a_byte(spark):
    """More near copies than any fixed number of nodes to score, which bytes cannot tell apart."""
    rng = np.random.default_rng(7)
    wild = rng.normal(size=(400, 32))
    wild[100:] = wild[0] + rng.normal(size=(300, 32)) * 1e-5
    data = [(i, v) for i, v in enumerate(wild.astype(np.float32).tolist())]
    found = got(neighbours.nearest(spark.createDataFrame(data, ROWS), F.col("vec_id") % 10 == 0))
    assert recall(found, brute(data, lambda i: i % 10 == 0, 20)) == 1


def test_many_tiles_and_passes(spark, monkeypatch):
    """Bounds small against the rows: a third of them unequal near copies, and many equal scores."""
    monkeypatch.setattr(neighbours, "TILE", (7, 16))
    monkeypatch.setattr(neighbours, "QUERY_CELLS", 16 * 16)
    monkeypatch.setattr(neighbours, "PAIR_CELLS", 16 * 5)
    data, _ = dense(900, 16, 0.0005, 8)
    found = got(neighbours.nearest(spark.createDataFrame(data, ROWS), F.col("vec_id") % 20 == 0))
    assert recall(found, brute(data, lambda i: i % 20 == 0, 20)) == 1
    check_scores(found, data)
    whole = np.random.default_rng(9).integers(-2, 3, (700, 6)).astype(float).tolist()
    data = list(enumerate(whole))
    assert got(neighbours.nearest(spark.createDataFrame(data, ROWS), F.col("vec_id") % 20 == 0)) == brute(data, lambda i: i % 20 == 0, 20)


def test_the_sql_gives_the_same_doubles(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"))
    sql = neighbours.ORACLE.replace("FROM embeddings", f"FROM '{SF01}/embeddings.parquet'")
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, found.collect())) == sorted(duckdb.sql(sql).fetchall())


def test_unequal_lengths_are_told(spark):
    with pytest.raises(ValueError, match="unequal length: 2 and 3"):
        neighbours.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0, 3.0]), (2, None)], ROWS), F.lit(True))
