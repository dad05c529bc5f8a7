import pyarrow as pa
from compare import duck
from test_decontam import brute
from test_pii import slow_spans
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from conftest import SF001
from ledgerloom.llm import toxicity
from ledgerloom.llm.shared import materialise


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, SF001), "stage")
        assert docs.columns == columns
        kept[name] = ({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in docs.collect()})
        assert len(kept[name][1]) == docs.count()

    before, after = kept["toxicity"]
    model = toxicity.fit(spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet"))
    scores = model.score(pa.array([r.text for r in before.values()], pa.string()))
    assert set(after) == {d for d, s in zip(before, scores) if s < 0.7}

    before, after = kept["simhash_dedup"]
    prints = {d: slow_fingerprint(r.text) for d, r in before.items()}
    root = slow_components(prints.values(), 2)
    assert set(after) == {min(d for d in prints if root[prints[d]] == r) for r in set(root.values())}

    before, after = kept["benchmark_decontamination"]
    items = duck(SF001).sql("SELECT item_id, text FROM benchmark").fetchall()
    assert set(after) == set(before) - {d for d, _ in brute([(d, r.text) for d, r in before.items()], items)}

    before, after = kept["pii"]
    assert set(after) == set(before)
    for d, r in after.items():
        assert slow_spans(r.text) == [] and r.n_chars == len(r.text)
        if not slow_spans(before[d].text) and "[" not in r.text:
            assert r.text == before[d].text

    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert {r.doc_id for r in mixed} <= set(after) and [r.position for r in mixed] == sorted(r.position for r in mixed)
    assert sum(r.words for r in mixed) > 0


def test_every_operator_is_registered():
    from ledgerloom.llm import queries

    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
