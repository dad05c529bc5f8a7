import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, edge_docs, empty, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from ledgerloom.llm import variants

DOCS = "doc_id long, text string"


def slow_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(docs):
    n = slow_words(docs)
    near = {w: [] for w in n}
    listed = sorted(n)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = slow_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert found(variants.variants(docs)) == want and any(r[1] for r in want)


@pytest.mark.parametrize("group", [2, 5, 100])
def test_crowded_partitions_are_split_without_loss(spark, group):
    """Words of few letters, many in each partition, by walks and by splits."""
    rng = np.random.default_rng(group)
    words = {"".join(rng.choice(list("abé"), int(k))) for k in rng.integers(7, 11, 400)} | {"a" * k for k in range(7, 14)}
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [(r.word, r.near) for r in variants.near_words(df, group).collect()]
    want = [(a, b) for a in words for b in words if a != b and abs(len(a) - len(b)) <= 1 and one_edit(a, b)]
    assert sorted(got) == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", max_size=6), max_size=30))
def test_composition_accepts_exactly_the_near_pairs(words):
    got = [tuple(sorted(p)) for p in variants.near_pairs(words)]
    assert sorted(got) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def test_the_acceptor_is_minimal():
    a = variants.Acceptor(sorted(["tapping", "topping", "tap", "top", "stopping"]))
    rights = set()

    def right(p):
        out = {""} if a.final[p] else set()
        return frozenset(out | {c + w for c, q in a.moves[p].items() for w in right(q)})

    rights = [right(p) for p in range(len(a.moves))]
    assert len(set(rights)) == len(rights) and rights[a.start] == {"tapping", "topping", "tap", "top", "stopping"}


def test_long_words_take_linear_steps():
    long = "a" * 100_000
    assert list(variants.near_pairs([long, long + "b", long + "bc"])) != []


def test_chains_of_forms_end_at_one_root(spark):
    # 200, 20 and 2 occurrences, each one edit from the next
    text = " ".join(["colouring"] * 200 + ["coloring"] * 20 + ["colorinn"] * 2)
    doc_id = next(i for i in range(100) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in set(text.split())))
    got = {r.word: (r.form, r.root, r.n_near) for r in variants.variants(spark.createDataFrame([(doc_id, text)], DOCS)).collect()}
    assert got == {
        "colouring": (None, "colouring", 1), "coloring": ("colouring", "colouring", 2), "colorinn": ("coloring", "colouring", 1),
    }


def test_a_long_text_in_pieces(monkeypatch):
    text = " ".join(f"wording{'abcdefgh'[i % 8]} x{i}" for i in range(500))
    whole = Counter()
    variants.count_words("5", text.encode(), whole)
    monkeypatch.setattr(variants, "PIECE", 50)
    pieces = Counter()
    variants.count_words("5", text.encode(), pieces)
    assert whole == pieces and whole.total() == 500


def test_edge_cases(spark):
    docs = edge_docs(spark)
    got = variants.variants(clashing(docs))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(got) == slow_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(variants.variants(empty(docs))) == []
