"""Alignment of tokenizers against a version that compares every token of a text with every other."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyflow.llm.alignment import Aligned, _packed, _unpacked, align_tokenizers, check_pieces, coalesced, overlaps
from tallyflow.llm.bytelevel import load_tokenizer, token_bytes
from tallyflow.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    "The naïve tokenizers disagree: déjà vu, 12345 and snow\u2603man.",
    "a  b\t\tc\r\nd;\r\n  e \xa0 f\xa0g \u3000 h\x1c i\x85 j   ",
    " leading and trailing ",
    "<|endoftext|> <s> </s> <0x41> it's we'll DON'T",
    "日本語のテキスト 🙂🙃 e\u0301 \u0308x",
    "tie tie tie",
    "tie tie tie",
    " ",
    "\n\n \n",
    "x" * 3000,
    "word " * 2000,
    "has \u2581 mark",
    "",
    None,
]


def _tokens(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=B)
    a = load_tokenizer(A).encode(" " + text, add_special_tokens=False).ids
    b = model.encode(text)
    piece = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    return a, b, [token_bytes(A)[i] for i in a], [piece(i) for i in b]


def brute(texts):
    """Rows in the order of the texts, by comparing all tokens of a text."""
    rows, linked = [], []
    for text in texts:
        links, groups = [], []
        if text:
            a, b, x, y = _tokens(text)
            if b"".join(x) == b"".join(y) == (" " + text).encode():
                a_ends, b_ends = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
                low = 0
                for cut in sorted(set(a_ends) & set(b_ends)):
                    groups.append(([i for i, e in zip(a, a_ends) if low < e <= cut], [i for i, e in zip(b, b_ends) if low < e <= cut]))
                    low = cut
                links = [(i, j) for i, e, s in zip(a, a_ends, [0, *a_ends]) for j, f, t in zip(b, b_ends, [0, *b_ends]) if max(s, t) < min(e, f)]
        linked.append(links)
        digest = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        rows.append([len([i for p, _ in groups for i in p]), len([i for _, q in groups for i in q]), len(groups), len(links), hashlib.sha256(digest.encode()).hexdigest() if groups else ""])
    counts = Counter(pair for links in linked for pair in set(links))
    best: dict = {}
    for (a, _), n in counts.items():
        best[a] = max(n, best.get(a, 0))
    return [tuple([*r[:4], sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), r[4]]) for r, links in zip(rows, linked)]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_equals_brute_force(spark, most):
    texts = [t if t is None or len(t) < 2500 else t[:2500] for t in TEXTS]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("row", "pairs", "code", "n", "best")})
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in align_tokenizers(df.repartition(3), A, B, most).collect()}
    want = brute(texts)
    for i, row in enumerate(want):
        assert got[i] == row, texts[i]
    assert len(got) == len(texts) and got[11][0] == got[12][0] == got[13][0] == 0


def test_whole_documents_of_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1500").select("doc_id", "text").orderBy("doc_id").collect()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in align_tokenizers(df, A, B).collect()}
    assert [got[r.doc_id] for r in rows] == brute([r.text for r in rows])


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    rows = align_tokenizers(df, A, B).collect()
    assert len(rows) == 4 and {(r.n_links, r.count_sum) for r in rows} == {(0, 0), (2, 6)}
    assert align_tokenizers(df.where("false"), A, B).count() == 0


def test_pieces_are_kept_within_a_bound(monkeypatch):
    from tallyflow.llm import alignment

    monkeypatch.setattr(alignment, "KEPT", 2000)
    known = Aligned(A, B)
    pieces = [f" word{i % 37}" for i in range(400)]
    for low in range(0, 400, 10):
        numbers = known.numbers(pieces[low : low + 10])
        assert [known.texts[n].count("|") for n in numbers] == known.figures[numbers, 2].tolist()
    assert len(known.index) < 37
    check_pieces(B)


def test_intervals():
    starts, ends, side = np.array([0, 3, 5, 0, 2, 5]), np.array([3, 5, 9, 2, 5, 9]), np.array([0, 0, 0, 1, 1, 1])
    assert coalesced(starts, ends, side).tolist() == [0, 0, 1, 0, 0, 1]
    left, right = overlaps(starts[:3], ends[:3], starts[3:], ends[3:])
    assert list(zip(left.tolist(), right.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2)]
    codes, times = np.array([3, 9, 2**60], np.uint64), np.array([1, 7, 2], np.uint64)
    assert all((x == y).all() for x, y in zip(_unpacked(_packed(codes, times)), (codes, times)))
    assert len(_unpacked(_packed(codes[:0], times[:0]))[0]) == 0
