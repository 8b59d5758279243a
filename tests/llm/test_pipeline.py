"""The pipeline's stages against brute force on the smallest tables."""
import os

import pytest

import brute
import corpus_pipeline as C
from telemark.llm.tables import stored

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(C.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "decontamination", "best_fit_packing"]

    kept = stored(stages["toxicity"](spark, docs, SF), "stage")
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert not any(labels.get(i) == 0 for i in gone)

    single = stored(stages["ngram_jaccard_join"](spark, kept, SF), "stage")
    groups = brute.groups({r.doc_id: r.text for r in kept.collect()}, 5, 80)
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted({g for _, g in groups.values()})

    clean = stored(stages["decontamination"](spark, single, SF), "stage")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = sorted(r.doc_id for r in single.collect() if brute.contamination(r.text, items)[1] == 0)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == want

    packed = stages["best_fit_packing"](spark, clean, SF).collect()
    words = {}
    for p in packed:
        words[p.doc_id] = words.get(p.doc_id, 0) + p.n_words
    assert words == {r.doc_id: len(brute.NONBLANK.findall(r.text)) for r in clean.collect()}
    source = {r.doc_id: r.source for r in clean.collect()}
    seats = [(p.bin_id, source[p.doc_id]) for p in packed if p.bin_id is not None and p.n_words < 2048]
    assert len(seats) == len(set(seats))
    assert sorted((p.doc_id, p.piece, p.n_words) for p in C.run(spark, SF).collect()) == sorted((p.doc_id, p.piece, p.n_words) for p in packed)
