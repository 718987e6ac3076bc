import re

import corpus_pipeline
from stockwave.llm import ngram_join, packing, pii, quality_model
from stockwave.llm.common import table
from stockwave.session import stage

from samples import SF
from test_packing import check
from test_ngram_join import shingle_set


def test_stages_one_by_one(spark):
    """Every stage against a plain version of it, on what the stage before has kept."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["classify", "deduplicate", "redact", "mix", "pack"]
    docs = table(spark, SF, "documents")
    steps = dict(corpus_pipeline.STAGES)

    kept = stage(steps["classify"](spark, docs, SF), "t")
    assert kept.columns == docs.columns
    model = quality_model.fit(docs, table(spark, SF, "labels"))
    tools = quality_model.WordSlots(), quality_model.class_of_byte()
    want = {r.doc_id for r in docs.collect() if model.score(*quality_model.features(r.text, r.n_chars, *tools)) >= quality_model.THRESHOLD}
    assert {r.doc_id for r in kept.collect()} == want and 0 < len(want) < docs.count()

    single = stage(steps["deduplicate"](spark, kept, SF), "t")
    groups = ngram_join.groups(kept).collect()
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups if r.n_shingles} | {r.doc_id for r in groups if not r.n_shingles})
    texts = [shingle_set(r.text) for r in single.collect()]
    near = [1 for i, a in enumerate(texts) for b in texts[:i] if a and b and 100 * len(a & b) >= 80 * len(a | b)]
    assert not near

    clean = stage(steps["redact"](spark, single, SF), "t")
    before, after = ({r.doc_id: r for r in df.collect()} for df in (single, clean))
    assert clean.columns == docs.columns and before.keys() == after.keys()
    for k, r in after.items():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        if not pii.base_spans(before[k].text):
            assert r.text == before[k].text or re.search("<(email|ip|card|phone)>", r.text)

    mixed = stage(steps["mix"](spark, clean, SF), "t")
    assert mixed.columns == docs.columns
    words = {r.doc_id: len((r.text or "").split()) for r in clean.collect()}
    total, taken = sum(words.values()), sum(words[r.doc_id] for r in mixed.collect())
    assert 0.9 * total < taken <= total

    packed = steps["pack"](spark, mixed, SF)
    pieces = packed.collect()
    assert sum(p.piece == 0 for p in pieces) == mixed.count()
    assert check(pieces, packing.CAPACITY) == -(-sum(p.length for p in pieces) // packing.CAPACITY)


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, step in corpus_pipeline.STAGES:
            found = stage(step(spark, docs, SF), f"t-{name}")
            if name != "pack":
                assert found.columns == docs.columns
                docs = found
        assert found.columns[-2:] == ["sequence_id", "offset"]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
