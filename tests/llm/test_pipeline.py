"""The stages one after the other, and what each of them keeps."""

import corpus_pipeline
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    from test_lines import _plain as lines_plain
    from test_minhash import _plain as near_plain

    from tallyflow.llm.toxicity import toxicity_scores

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "minhash_dedup", "source_mixing", "best_fit_packing"]
    clean = stages["toxicity"](spark, docs, DIR).cache()
    scores = toxicity_scores(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    assert clean.columns == names
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in scores.where("score < 0.5").collect())
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    lines = stages["line_dedup"](spark, clean, DIR).cache()
    expected = {i: t for i, t in lines_plain(rows).items() if t is None or t.split() or t == dict(rows)[i]}
    assert lines.columns == names and {r.doc_id: r.text for r in lines.collect()} == expected
    near = stages["minhash_dedup"](spark, lines, DIR).cache()
    plain = near_plain(list(expected.items()))
    assert near.columns == names and sorted(r.doc_id for r in near.collect()) == sorted(i for i, (_, c) in plain.items() if i == c)
    mixed = stages["source_mixing"](spark, near, DIR).cache()
    texts = {r.doc_id: r.text.split() for r in near.where("text is not null").collect()}
    taken: dict = {}
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
        assert len(r.text.split()) == sum(p.words for p in r.places) and r.n_chars == len(r.text)
        assert set(r.text.split()) <= set(texts[r.doc_id])
    assert all(n <= 2 * len(texts[i]) for i, n in taken.items())
    sequences = stages["best_fit_packing"](spark, mixed.select(*names), DIR)
    sums = sequences.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in sums)
    assert corpus_pipeline.run(spark, DIR).count() > 0
