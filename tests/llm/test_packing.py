"""Pieces against the tokenizer over whole texts, and what each sequence holds."""

import zlib

import numpy as np

from tallyflow.llm import packing
from tallyflow.llm.queries import tokenizer_path

TEXTS = ["<|startoftext|> <|STARTOFTEXT|>x It's. A,B. éÉ. ΑΣ. ́a á. x\x00y a　b 12. ..,", "ABC <|EndOfText|>. x.", None, "", " \n ", "\ta  B\x0bc\x0c d1, e2. ", "word " * 5000]


def test_pieces_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    path, size = tokenizer_path("word_bpe_49k.json"), 256
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    encoder, expected = Tokenizer.from_file(path), {}
    for r in docs.collect():
        ids = np.array([*encoder.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), size)):
            expected[r.doc_id, k] = (at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes()))
    rows = packing.pack_documents(docs, path, size).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    ends: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= size and len(ends) <= 1.1 * -(-sum(ends.values()) // size)


def test_words_that_were_dropped_are_encoded_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_BYTES", 100)
    monkeypatch.setattr(packing, "_LATELY", 2)
    words = packing._Words(tokenizer_path("word_bpe_49k.json"))

    def ids(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return packing._ids(data, np.array([0, len(data)]), words)[0].tolist()

    for text in ("alpha beta. gamma", "delta alpha x1,", "beta. gamma", "alpha beta. gamma delta"):
        assert ids(text) == words.encoder.encode(text, add_special_tokens=False).ids
