import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import clashing, edge_docs, empty, rows
from pyspark.sql import functions as F

from conftest import SF001
from ledgerloom.llm import jaccard

DOCS = "doc_id long, text string"


def slow_set(text, size=5):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def slow_join(docs, size=5, percent=80):
    sets = [slow_set(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def crowd(seed):
    """Chains of edits, copies, a passage that many share, and a crowd of near copies whose members
    are often not near each other."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(50)]
    texts = []
    for _ in range(8):  # chains: each text a little off the one before
        t = [word() for _ in range(rng.randrange(8, 90))]
        for _ in range(10):
            texts.append(" ".join(t))
            t = t.copy()
            t[rng.randrange(len(t))] = word()
            if rng.random() < 0.3:
                t = t[: -rng.randrange(1, 4)]
    base = [word() for _ in range(120)]
    for _ in range(60):
        t = base.copy()
        for _ in range(rng.randrange(5)):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
    texts += [" ".join([word() for _ in range(rng.randrange(0, 60))] + passage) for _ in range(60)]
    texts += [rng.choice(texts).upper() for _ in range(40)] + [" ".join(word() for _ in range(k)) for k in range(9)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,percent", [(1, 80), (2, 80), (3, 65)])
def test_crowds_against_brute_force(spark, seed, percent):
    docs = crowd(seed)
    want = slow_join(docs, percent=percent)
    assert found(jaccard.join(spark.createDataFrame(docs, DOCS), percent=percent)) == want
    assert len({c for _, _, c in want}) < len(docs) * 0.8


def test_documents_against_brute_force_and_sql(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = found(jaccard.join(docs))
    assert got == slow_join([(r.doc_id, r.text) for r in docs.collect()])
    sql = jaccard.ORACLE.replace("FROM documents", f"FROM '{SF001}/documents.parquet'")
    assert got == sorted(duckdb.sql(sql).fetchall(), key=repr)


def test_without_stars_the_pairs_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "STARS", 0)
    docs = crowd(5)
    assert found(jaccard.join(spark.createDataFrame(docs, DOCS))) == slow_join(docs)


def test_a_crowd_needs_few_comparisons(spark):
    """300 near copies of one text: one comparison each, none of their 44,850 pairs later."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(300):
        t = base.copy()
        t[rng.randrange(200)] = f"x{i}"
        texts.append((i, " ".join(t)))
    op = jaccard.Join(spark.createDataFrame(texts, DOCS))
    heads = op.heads()
    none = spark.createDataFrame([], "node long, root long")
    assert op.stars(op.classed(heads, none)).count() <= 300
    assert {r.component_id for r in jaccard.join(spark.createDataFrame(texts, DOCS)).collect()} == {0}
    assert op.crossing(op.classed(heads, op.components())).isEmpty()


def plan_of(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_heads_are_met_by_set_and_dealt_by_gram_once(spark, monkeypatch):
    """The join that picks the sets of some pairs gives a row for each set, however many n-grams its
    head shares, and the passes by n-gram deal the heads once each."""
    base = [f"b{i}" for i in range(200)]
    texts = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(30)]
    op = jaccard.Join(spark.createDataFrame(texts, DOCS))
    heads = op.heads()
    assert heads.columns == ["gram", "id", "n", "pos"]
    assert op.lists.count() == 30 < heads.count() == heads.distinct().count()
    assert heads.groupBy("gram").agg(F.countDistinct("id").alias("k")).where("k < 2").isEmpty()
    none = spark.createDataFrame([], "node long, root long")
    classed = op.classed(heads, none)
    pairs = jaccard.materialise(op.stars(classed), "pairs")
    assert op.promising(pairs).count() == pairs.count() > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lines = plan_of(op.crossing(classed), "simple").splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("hashpartitioning(gram" in x and "Exchange" in x for x in lines) <= 2  # the same for both sides
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: df)
    for plan in (plan_of(op.alive(heads), "simple"), plan_of(op.stars(classed), "simple")):
        assert plan.count("Exchange hashpartitioning(gram") == 1 and "Join" not in plan


def test_pieces_are_dealt_once_and_cut_as_the_pairs_need_them(spark, monkeypatch):
    """A comparison reads one exchange of the pieces, of which no table is written, and a set is cut as
    the larger set of its pairs is, not as any partner might be; the pairs are not broadcast."""
    monkeypatch.setattr(jaccard, "PIECE", 64)
    base = [f"b{i}" for i in range(250)]
    texts = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(12)]
    texts += [(i + 20, " ".join([f"{i}", *base, *[f"y{i}" for i in range(11 + i)]])) for i in range(2)]
    op = jaccard.Join(spark.createDataFrame(texts, DOCS))
    rows_ = jaccard.materialise(op.classed(op.heads(), spark.createDataFrame([], "node long, root long")), "classed")
    pairs = jaccard.materialise(op.stars(rows_), "pairs")
    needed = {(x, jaccard.cuts_of(max(r.na, r.nb))) for r in pairs.collect() for x in (r.a, r.b)}
    seen = {}
    keep, cut, overlaps = jaccard.materialise, jaccard._fragments, jaccard._partial_overlaps
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: keep(seen.setdefault(name, df), name))
    monkeypatch.setattr(jaccard, "_fragments", lambda *args: seen.setdefault("cut", cut(*args)))
    monkeypatch.setattr(jaccard, "_partial_overlaps", lambda rows: overlaps(seen.setdefault("met", rows)))
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        found_ = op.verified(pairs).count()
        plan = plan_of(seen["met"], "simple")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert found_ == pairs.count() == len(texts) - 1
    assert {(r.id, r.cuts) for r in seen["cut"].select("id", "cuts").distinct().collect()} == needed
    assert plan.count("MapInArrow") == 1 and plan.count("ReusedExchange") == 1 and "Broadcast" not in plan
    assert "jaccard-pieces" not in seen


def test_the_pairs_of_several_classes_meet(spark):
    """Crossing against all pairs of sets of different classes, with classes of several sizes."""
    docs = crowd(9)
    op = jaccard.Join(spark.createDataFrame(docs, DOCS))
    heads = [tuple(r) for r in op.heads().collect()]
    ids = sorted({r[1] for r in heads})
    roots = {x: ids[i - i % 3] for i, x in enumerate(ids) if i % 2}
    got = op.crossing(op.classed(op.heads(), spark.createDataFrame(list(roots.items()), "node long, root long")))
    got = {tuple(sorted((r.a, r.b))) for r in got.collect()}
    by_gram, want = {}, set()
    for gram, x, n, pos in heads:
        by_gram.setdefault(gram, []).append((x, n, pos))
    for rows_ in by_gram.values():
        for x, n, i in rows_:
            for y, m, j in rows_:
                least = -(-(n + m) * 80 // 180)
                if x < y and roots.get(x, x) != roots.get(y, y) and 100 * min(n, m) >= 80 * max(n, m) and min(n - i, m - j) >= least:
                    want.add((x, y))
    assert got == want and len(want) > 50


def test_fragments_partition_a_set_in_one_order():
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    counters = rng.integers(-3, 4, jaccard.CELLS)
    cell, sign = jaccard.Order.cell(grams[:200], jaccard.CELLS)
    counters[cell] = 1000 * (1 - 2 * sign)
    order = jaccard.Order(counters)
    for cuts in (1, 4):
        parts = dict(order.fragments(grams, cuts))
        frequent = np.concatenate([p for k, p in parts.items() if k >= cuts])
        assert set(grams[:200]) <= set(frequent) and max(parts) < 2 * cuts
        assert sorted(np.concatenate(list(parts.values()))) == grams.tolist()
    assert set(order.arranged(grams)[-150:]) <= set(frequent)  # frequent ones last


def test_cuts_agree_in_python_and_spark(spark):
    sizes = [1, 2, 255, 256, 257, 511, 512, 513, 1024, 1025, 5000, 10**6]
    rows = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", jaccard._cuts_of(F.col("n")).alias("cuts")).collect()
    assert [(r.n, r.cuts) for r in rows] == [(n, jaccard.cuts_of(n)) for n in sizes]
    assert all(n / jaccard.cuts_of(n) <= jaccard.PIECE for n in sizes)


def test_long_sets_are_compared_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 8)
    docs = crowd(11)
    assert found(jaccard.join(spark.createDataFrame(docs, DOCS))) == slow_join(docs)


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"Word{i * i % 3001}" for i in range(20_000))
    column = pa.array([None, text, "a b", "", "one two three four five", "x" * 5000])
    whole = [(r, s.tolist()) for r, s in jaccard.shingle_sets(column)]
    monkeypatch.setattr(jaccard, "BLOCK", 700)
    pieces = [(r, s.tolist()) for r, s in jaccard.shingle_sets(column)]
    assert pieces == whole
    sizes = {r: len(s) for r, s in whole}
    assert all(sizes.get(i, 0) == len(slow_set(t)) for i, t in enumerate(column.to_pylist()))


def test_edge_cases(spark):
    docs = edge_docs(spark)
    got = jaccard.join(clashing(docs))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert found(got) == slow_join([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(jaccard.join(empty(docs))) == []
    with pytest.raises(ValueError, match="percent"):
        jaccard.join(docs, percent=20)
