"""The pipeline's stages against brute force, each on what the one before it kept."""

from __future__ import annotations

import corpus_pipeline
from palabre.llm.common import stage
from palabre.llm.toxicity import score_toxicity, train_toxicity
from tests.llm.test_methods import brute_components
from tests.oracle import SF_DIR


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, inputs, outputs = docs.columns, {}, {}
    for name, function in corpus_pipeline.STAGES:
        inputs[name] = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(function(spark, docs, SF_DIR), name)
        outputs[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    assert list(inputs) == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    ids = {name: {r.doc_id for r in rows} for name, rows in outputs.items()}

    all_docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = train_toxicity(all_docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert ids["toxicity"] == {r.doc_id for r in score_toxicity(all_docs, model).collect() if not r.predicted}

    last = {}
    for i, text in sorted(inputs["exact_dedup"].items()):
        last[lower(text)] = i
    assert ids["exact_dedup"] == set(last.values())

    groups = brute_components(inputs["near_dedup"])
    assert ids["near_dedup"] == {i for i, (_, head) in groups.items() if i == head}

    assert ids["pii"] == ids["near_dedup"] == ids["packing"]
    assert all(r.n_chars == len(r.text) for r in outputs["pii"])
    assert sum(r.length for r in outputs["packing"]) >= len(ids["packing"])


def test_run_is_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows) > 0
