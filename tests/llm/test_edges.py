"""Nulls, empty and odd texts, repeated rows, empty tables and clashing columns for every operator."""

import pytest
from pyspark.sql import functions as F

from tallyflow.llm.embedding_dedup import embedding_dedup
from tallyflow.llm.line_dedup import line_dedup
from tallyflow.llm.minhash_dedup import minhash_dedup
from tallyflow.llm.mixing import mix_documents, mix_shares
from tallyflow.llm.packing import best_fit, pack_documents
from tallyflow.llm.quality_nbsvm import quality_scores
from tallyflow.llm.quality_rules import quality_rules
from tallyflow.llm.queries import tokenizer_path
from tallyflow.llm.secrets import find_secrets, secret_digest
from tallyflow.llm.token_counts import token_counts
from tallyflow.llm.toxicity import toxicity_scores

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 30
ROWS = [(1, LONG, "en", "a", 1), (2, LONG, "en", None, 1), (2, LONG, "en", None, 1), (3, None, None, "b", None), (4, "", "en", "a", 0), (5, " \n\t\n", "en", "b", 3), (None, "one two three", None, "a", 1), (6, "password = abcdefghijkl0 and 0123456789abcdef", "en", "c", 1), (7, "é ñ <|endoftext|> x", "en", "c", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in ("score", "kept", "n", "id", "line", "bucket", "size", "words", "label", "value")})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in (1, 2, 3, 4, 5, 6, 7)] + [(None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")


def _all(docs, labels):
    return {
        "lines": lambda: line_dedup(docs),
        "tokens": lambda: token_counts(docs, tokenizer_path("piece_bpe_32k.model")),
        "quality": lambda: quality_scores(docs, labels),
        "rules": lambda: quality_rules(docs),
        "minhash": lambda: minhash_dedup(docs),
        "mix": lambda: mix_shares(docs),
        "toxicity": lambda: toxicity_scores(docs, labels),
        "secrets": lambda: secret_digest(find_secrets(docs)),
    }


@pytest.mark.parametrize("name", ["lines", "tokens", "quality", "rules", "minhash", "mix", "toxicity", "secrets"])
def test_odd_rows_and_empty_tables(docs, labels, name):
    assert _all(docs, labels)[name]().count() == len(ROWS)
    assert _all(docs.where("false"), labels.where("false"))[name]().count() == 0


def test_packing(docs):
    got = pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 256).collect()
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    used: dict = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 256
    assert pack_documents(docs.where("false"), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_every_capacity_binds():
    import numpy as np

    lengths = np.array([5, 5, 4, 3, 3, 2, 2, 1, 1, 1])
    for rule in ("norm", "dot"):
        bins, _ = best_fit(lengths, 10, 2, 1e9, (1, 1, 1), rule)
        assert np.bincount(bins).max() <= 2 and np.bincount(bins, lengths).max() <= 10
        bins, _ = best_fit(lengths, 10, 10, 30.0, (1, 0, 1), rule)
        assert np.bincount(bins, lengths.astype(float) ** 2).max() <= 30


def test_mixed_documents(docs):
    out = mix_documents(docs)
    assert out.columns == docs.columns and out.where("text rlike 'alpha'").count() >= 1
    assert mix_documents(docs.where("false")).count() == 0


def test_minhash_copies(docs):
    got = {r.doc_id: r for r in minhash_dedup(docs).collect()}
    assert got[2].component_id == 1 and not got[2].kept and got[3].n_shingles == 0 and got[3].kept and got[4].component_id == 4


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [2.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup(df).collect()}
    assert len(got) == len(rows)
    assert [got[i].n_links for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [2, 2, 0, 0, 0, 0, 0, 0, 2]
    assert got[9].component_id == 1 and not got[9].kept and got[None].kept
    assert embedding_dedup(df.where("false")).count() == 0


def test_token_counts_by_brute_force(spark, monkeypatch):
    from tallyflow.llm import token_counts as module

    path = tokenizer_path("piece_bpe_32k.model")
    scores = module.unigram_scores(path)
    longest, byte = max(map(len, scores)), min(scores.values()) - 10.0

    def plain(text):
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            n = len(text[end - 1].encode())
            options = [(best[-1][0] + n * byte, -(best[-1][1] + n))]
            options += [(best[k][0] + scores[text[k:end]], -best[k][1] - 1) for k in range(max(0, end - longest), end) if text[k:end] in scores]
            top = max(options)
            best.append((top[0], -top[1]))
        return best[-1][1]

    words = ["the", "there", "therein", "thé", "x", "ñandú", "interoperability", "漢字", "aaaaaaaa", "abc" * 300, "\U0001f600" * 90]
    trie = module.Trie(scores)
    assert trie.counts([w.encode() for w in words + words[::-1]]) == [plain(module.MARK + w) for w in words + words[::-1]]
    assert len(trie.score) < sum(len(w) + 1 for w in words if len(w) < 199)  # prefixes are shared
    monkeypatch.setattr(module, "NODES", 3)
    assert trie.counts([b"there"]) == [plain(module.MARK + "there")] and len(trie.score) == 7
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode().split() for r in docs.collect()}
    known = {w: plain(module.MARK + w.decode()) for ws in texts.values() for w in ws}
    for r in token_counts(docs, path).collect():
        assert (r.n_pretokens, r.n_tokens) == (len(texts[r.doc_id]), sum(known[w] for w in texts[r.doc_id]))


def test_block_max_is_exact():
    import numpy as np

    from tallyflow.llm.toxicity import BlockMaxIndex

    rng = np.random.default_rng(3)

    def made(n):
        terms = np.sort(rng.choice(60, size=n, replace=False, p=np.arange(60, 0, -1) / 1830))
        weights = rng.random(n)
        return terms, weights / np.sqrt(weights @ weights)

    vectors = [made(1 + i % 9) for i in range(500)] + [made(3)] * 20
    dense = np.zeros((len(vectors), 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for block, long in ((16, 4), (64, 24), (1024, 1000)):
        index = BlockMaxIndex(vectors, 60, block, long)
        for q in vectors[:60] + vectors[-1:]:
            cosines = np.round(dense[:, q[0]] @ q[1], 12)
            plain = [i for i in np.lexsort((np.arange(len(cosines)), -cosines))[:15] if cosines[i] > 0]
            near, ids = index.nearest(*q, 15)
            assert ids.tolist() == plain and np.allclose(near, cosines[plain])


def test_counts_asked_for_lately_outlive_the_cache(monkeypatch):
    from tallyflow.llm import token_counts as module

    trie = module.Trie({module.MARK: -1.0, module.MARK + "a": -2.0, "b": -2.5, "ab": -3.0})
    made, insert = [], trie.insert
    monkeypatch.setattr(trie, "insert", lambda w: made.append(w) or insert(w))
    monkeypatch.setattr(module, "CACHED", 20)
    for i in range(40):
        assert trie.counts([b"ab", b"b", b"c%d" % i])[:2] == [2, 2]
    assert made.count("ab") == made.count("b") == 1 and len(made) == 42
    assert len(trie.terminal) + len(trie.before) <= 20
