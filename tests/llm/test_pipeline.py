"""The pipeline against its stages in plain Python."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from lawloom.llm import quality
from tests.llm import brute
from tests.llm.brute import SF


def test_pipeline_against_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_quality(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    good = quality.score_documents(documents, model).filter("score >= 0.7")
    rows = {r.doc_id: r for r in good.collect()}
    texts = brute.line_dedup({i: r.text for i, r in rows.items()})
    groups = brute.components({i: brute.shingles(t, 5) for i, t in texts.items()}, 80)
    texts = {i: t for i, t in texts.items() if groups[i] == i}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    leaked = {d for d, _ in brute.leaks(texts, items)}
    texts = {i: t for i, t in texts.items() if i not in leaked}
    sizes = Counter()
    for i, t in texts.items():
        sizes[rows[i].source] += len(brute.words(t))
    targets = brute.targets(dict(sizes))
    want = Counter()
    for i, t in texts.items():
        source = rows[i].source
        for k in range(brute.copies(i, targets[source] / sizes[source]) if sizes[source] else 0):
            want[i, t, len(t), source, k + 1] += 1
    got = Counter((r.doc_id, r.text, r.n_chars, r.source, r.copy_no) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and leaked and len(texts) > 50


def test_stages_take_odd_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            last = name == corpus_pipeline.STAGES[-1][0]
            assert last or out.columns == docs.columns, name
            assert docs is odd_documents or not rows, name
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources",
    ]
