"""The pipeline's stages one after the other, each against what it should keep."""

import re

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_hits, lower


def test_stages_keep_what_they_should(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    bench = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = {r["doc_id"] for r in docs.collect()}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "language ID":
            assert after == {i for i, t in before.items() if re.search("[^\\W\\d_]", t or "")}
        elif name == "MinHash near-dedup":
            assert after == {i for i, (_, c) in brute_components(list(before.items()), 5, 80).items() if i == c}
        elif name == "benchmark decontamination":
            assert after == {r[0] for r in brute_hits(list(before.items()), bench) if not r[5]}
        elif name == "mixing sources to target weights":
            assert after <= before.keys() and 0.4 < sum(len(lower(before[i])) for i in after) / sum(map(len, before.values())) < 0.8
        else:
            assert after == before.keys() and docs.groupBy("shard", "slot").count().where("count > 1").count() == 0


def test_run_applies_all_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count() < spark.read.parquet(f"{sf}/documents.parquet").count()
