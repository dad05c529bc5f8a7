import re
from collections import Counter

import numpy as np
from helpers import LONG, clashing, edge_docs, empty, rows

from conftest import SF01
from ledgerloom.llm import decontam


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(w, n=5):
    n = min(n, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute(docs, items, threshold=0.8):
    out, items = {}, [(i, words(t)) for i, t in items]
    for d, text in docs:
        w = words(text)
        own = set(shingles(w))
        for i, item in items:
            goal = shingles(item)
            if w and (own & set(goal) or len(item) < 5 or len(w) < 5):
                for at in range(max(1, len(w) - len(item) + 1)):
                    mine = shingles(w[at : at + len(item)])
                    both = (mine & goal).total()
                    like = both / max(mine.total() + goal.total() - both, 1)
                    if like >= threshold and like > out.get((d, i), 0):
                        out[d, i] = like
    return out


def got(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def test_whole_tables_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert want and got(decontam.contaminated(docs, items)) == want


def test_planted_passages_of_every_length(spark):
    """Exact, re-cased, re-punctuated and slightly edited passages at any place of a text."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    say = lambda n: [vocabulary[i] for i in rng.integers(5000, size=n)]
    items, docs = [], []
    for k, n in enumerate([1, 3, 5, 8, 14, 15, 19, 23, 30, 33, 37, 41, 47, 52, 59, 75, 130]):
        item = say(n)
        items.append((k, " ".join(item)))
        for j in range(8):
            told = list(item)
            if j == 1:
                told = [w.upper() + "," for w in told]
            if j == 2 and n >= 30:
                told[0] = "changed"
            if j == 3 and n >= 59:
                told[n // 2] = "changed"
            before, after = say(int(rng.integers(60)) * (j != 4)), say(int(rng.integers(60)) * (j != 5))
            docs.append((len(docs), " ".join(before + told + after)))
    want = brute(docs, items)
    assert len(want) >= 8 * len(items)
    found = got(decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert found == want


def test_long_text_and_item_blocks(spark, monkeypatch):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "one two three four five six seven eight nine ten")]
    text = f"{LONG} {items[0][1]} {LONG} {items[1][1].upper()}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontam.contaminated(docs, bench)) == {(1, 1): 1.0, (1, 2): 1.0}
    monkeypatch.setattr(decontam, "ITEM_BYTES", 50)
    assert got(decontam.contaminated(docs, bench)) == {(1, 1): 1.0, (1, 2): 1.0}


def test_fingerprints_within_the_radius_share_a_block():
    rng = np.random.default_rng(1)
    for _ in range(300):
        flips = rng.choice(64, decontam.RADIUS, replace=False)
        per = np.bincount(flips // decontam.BLOCK_BITS, minlength=decontam.BLOCKS)
        assert per.min() <= decontam.RADIUS // decontam.BLOCKS


def test_edge_cases(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "x"), (4, "x"), (1, "quick brown fox jumps over the lazy dog")],
        "item_id long, text string",
    )
    found = decontam.contaminated(clashing(docs), clashing(items))
    assert got(found) == {(1, 1): 1.0, (2, 1): 1.0, (6, 4): 1.0}
    assert found.count() == 3
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    assert rows(decontam.contaminated(empty(docs), items)) == rows(decontam.contaminated(docs, empty(items))) == []


def test_counters_of_long_runs_are_exact():
    """Counters of four bits in one word run over within 100,000 features; windows count right."""
    rng = np.random.default_rng(2)
    features = rng.integers(0, 1 << 63, 100_000, dtype=np.uint64) | np.uint64(1 << 17 | 1)
    sums = decontam._prefix_sums(features)
    for at, n in ((0, 40), (99_000, 1000), (70_000, 3), (5, 30_000)):
        window = features[at : at + n]
        want = 2 * np.unpackbits(window.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=int) > n
        fp = int(decontam._fingerprints(sums[at + n : at + n + 1] - sums[at : at + 1], n)[0])
        # counter 4 j + k is bit j + 16 k
        assert [fp >> (4 * j + k) & 1 for k in range(4) for j in range(16)] == want.astype(int).tolist()


def test_the_tables_pass_over_no_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    items = [(i, rng.integers(0, 1 << 63, int(n), dtype=np.uint64)) for i, n in enumerate(rng.integers(30, 40, 30))]
    index = decontam.Index(items, 5, 0.8)
    assert sum(len(own) for _, groups in index.classes for own, _, _ in groups) == 30
    for _, groups in index.classes:
        for own, prints, least in groups:
            for _ in range(50):
                fp = prints[rng.integers(len(own))]
                for bit in rng.choice(64, decontam.RADIUS, replace=False):
                    fp = fp ^ np.uint64(1 << int(bit))
                blocks = np.array([fp]).view(np.uint16)
                assert sum(int(least[b][blocks[b]]) for b in range(decontam.BLOCKS)) <= decontam.RADIUS


def test_cleaning_moves_no_text(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    kept = decontam.decontaminate(docs, items)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    bad = {r.doc_id for r in decontam.contaminated(docs, items).collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad
