"""The corpus pipeline, stage by stage, against plain versions."""

import corpus_pipeline
from tallyloom.llm import quality, secretscan
from tallyloom.session import stage
from tests.llm.test_containment import brute
from tests.llm.test_models import plain_base, plain_statistics
from tests.llm.test_simhash import plain_components, plain_fingerprint

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "source_mix"]

    judged = {r["doc_id"]: r["kept"] for r in quality.assess(docs, labels).collect()}
    first = stage(steps["quality_rules"](spark, docs, DIR), "t")
    assert first.columns == corpus_pipeline.COLUMNS
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    assert kept == {d: t for d, t in texts.items() if judged[d]} and 100 < len(kept) < len(texts)
    assert all(plain_statistics(t)[0] >= 50 for t in kept.values())

    second = stage(steps["simhash_near_dedup"](spark, first, DIR), "t")
    parts = plain_components([(d, plain_fingerprint(t)) for d, t in kept.items()])
    alone = {r["doc_id"]: r["text"] for r in second.collect()}
    assert alone == {d: t for d, t in kept.items() if parts[d] == d} and second.columns == corpus_pipeline.COLUMNS

    third = stage(steps["benchmark_decontamination"](spark, second, DIR), "t")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaked = {d for d, *_ in brute(list(alone.items()), items)}
    clean = {r["doc_id"]: r["text"] for r in third.collect()}
    assert clean == {d: t for d, t in alone.items() if d not in leaked} and third.columns == corpus_pipeline.COLUMNS

    fourth = stage(steps["secret_scan"](spark, third, DIR), "t")
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in fourth.collect()}
    assert set(masked) == set(clean) and fourth.columns == corpus_pipeline.COLUMNS
    for d, (text, n) in masked.items():
        assert not plain_base(text)
        assert (secretscan.MASK in text and n == len(text)) if plain_base(clean[d]) else len(text) > 0

    last = steps["source_mix"](spark, fourth, DIR).collect()
    assert {r["doc_id"]: r["size"] for r in last} == {d: len(t.split()) for d, (t, _) in masked.items()}
    for source in {r["source"] for r in last}:
        own = [r for r in last if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
    whole = corpus_pipeline.run(spark, DIR).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, last))
