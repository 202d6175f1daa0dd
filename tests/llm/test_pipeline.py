"""The pipeline's stages against brute force, one after the other."""
import corpus_pipeline as P
from test_decontaminate import brute as hits
from test_minhash import brute as groups

from quaybook.llm.queries import op3_quadratic_discriminant
from quaybook.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF001, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in read_table(spark, SF001, "benchmark").select("item_id", "text").collect()]
    first = P.quality_classifier(spark, docs, SF001)
    assert first.columns == docs.columns
    left = {r.doc_id for r in first.collect()}
    assert left == {r.doc_id for r in op3_quadratic_discriminant(spark, SF001).collect() if r.predicted}
    second = P.minhash_near_dedup(spark, first, SF001)
    assert second.columns == docs.columns
    left = {d for d, _, c in groups([(d, texts[d]) for d in left]) if d == c}
    assert {r.doc_id for r in second.collect()} == left
    third = P.benchmark_decontamination(spark, second, SF001)
    assert third.columns == docs.columns
    left = {r[0] for r in hits([(d, texts[d]) for d in left], items) if not r[4]}
    assert {r.doc_id for r in third.collect()} == left
    assert {r.doc_id for r in P.run(spark, SF001).collect()} == left


def test_empty_documents(spark):
    docs = read_table(spark, SF001, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.collect() == []
