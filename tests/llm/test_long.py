"""Very long texts, ties and clashing columns: defined results, not mere survival."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyflow.llm.embedding_dedup import embedding_dedup
from tallyflow.llm.minhash_dedup import minhash_dedup
from tallyflow.llm.mixing import mix_shares
from tallyflow.llm.packing import pack_documents
from tallyflow.llm.quality_nbsvm import quality_scores
from tallyflow.llm.quality_rules import quality_rules
from tallyflow.llm.queries import tokenizer_path
from tallyflow.llm.toxicity import toxicity_scores

N = 60_000
LONG = " ".join(f"word{i}" for i in range(N))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG, "a"), (2, LONG + " end", "a"), (3, "short text of seven words in all", "b"), (4, "x" * 500_000, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_whole_long_texts_count(docs, spark):
    sizes = {r.doc_id: r.n_words for r in quality_rules(docs).collect()}
    assert sizes == {1: N, 2: N + 1, 3: 7, 4: 1}
    near = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup(docs).collect()}
    assert near[1] == (N - 4, 1, True) and near[2] == (N - 3, 1, False) and near[4] == (1, 4, True)
    taken = {r.doc_id: (r.size, r.source_size, r.taken) for r in mix_shares(docs).collect()}
    assert taken[1][0] == N and taken[1][1] == 2 * N + 1 and all(t <= 2 * s for s, _, t in taken.values())
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in (1, 2, 3, 4)], "doc_id long, quality int, toxic int")
    for scored in (quality_scores(docs, labels), toxicity_scores(docs, labels)):
        assert sorted(r.doc_id for r in scored.collect()) == [1, 2, 3, 4] and all(0 <= r.score <= 1 for r in scored.collect())


def test_long_documents_are_cut_into_full_pieces(docs):
    pieces: dict = {}
    for r in pack_documents(docs.where("doc_id < 4"), tokenizer_path("word_bpe_49k.json")).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    own = sorted(pieces[1], key=lambda r: r.piece)
    assert [r.length for r in own[:-1]] == [2048] * (len(own) - 1) and [r.start for r in own] == [2048 * i for i in range(len(own))]
    assert len(pieces[3]) == 1 and own[-1].length <= 2048


def test_vectors_with_clashing_columns_and_ties(spark):
    rows = [(i, [1.0, 0.0, 0.0] if i < 5 else [0.0, float(i % 3 + 1), 0.0] if i < 8 else [0.0, 0.0, 1.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("h1", "h2", "n", "key", "part", "component", "links", "first", "near", "vector")})
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup(df).collect()}
    assert got == {**{i: (4, 0, i == 0) for i in range(5)}, **{i: (2, 5, i == 5) for i in (5, 6, 7)}, 8: (0, 8, True)}
    assert embedding_dedup(df.where("false")).count() == 0


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    rows = [(i, f"a line of words number {i} {'again ' * 20}\nand a second one {i}", "en", "ab"[i % 2], 50) for i in range(12)] + [(None, "a text without id", "en", "a", 17), (13, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("own") for c in ("mark", "parts", "h", "kept", "score", "n_lines")})
    spark.createDataFrame([(i, i % 2, int(i == 3)) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert set(docs.columns) <= set(out.columns), name
        assert out.count() > 0 and out.where("mark != 'own' or parts != 'own'").count() == 0, name
        assert stage(spark, docs.where("false"), path).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), path).count() == 0
