"""Vector best-fit packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import os
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import _LOWER, cut, span_hashes, text_blocks, word_spans

#: Bytes that a worker's kept words take with their ids, in two generations: when the younger has half of this, it becomes the older.
CACHED_BYTES = 32 << 20
#: Words that are added to a generation before its index is sorted anew.
_LATELY = 50_000
#: Bytes of text that are split at once; a longer text is split by itself. Documents that Spark hands over at once.
_BLOCK, _BATCH = 1 << 19, 2048
_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])


class _Generation:
    """Words by their 64-bit hash, with their ids one after the other: about 26 bytes a word."""

    def __init__(self, kind: type):
        self.ids, self.used = np.zeros(1 << 16, kind), 0
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))
        self.index = [none, none]  # sorted by hash: the large part, and what came lately

    def bytes(self) -> int:
        return sum(20 * len(part[0]) for part in self.index) + self.ids.itemsize * self.used

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin, -1 where it is not known, and how many they are."""
        begin, length = np.full(len(h), -1), np.zeros(len(h), np.int64)
        for keys, b, n in self.index:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                begin[hit], length[hit] = b[at[hit]], n[at[hit]]
        return begin, length

    def add(self, h: np.ndarray, length: np.ndarray, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(len(ids) + self.used // 2 + (1 << 16), self.ids.dtype)])
        self.ids[self.used : self.used + len(ids)] = ids
        new = (h, self.used + np.cumsum(length) - length, length.astype(np.int32))
        self.used += len(ids)
        large, lately = self.index
        lately = self._sorted(lately, new)
        self.index = [large, lately] if len(lately[0]) < _LATELY else [self._sorted(large, lately), tuple(x[:0] for x in large)]

    @staticmethod
    def _sorted(one, two):
        keys = np.concatenate([one[0], two[0]])
        order = np.argsort(keys, kind="stable")
        return tuple(np.concatenate(x)[order] for x in zip(one, two, strict=True))


def _spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... to each length, one after the other."""
    ends = np.cumsum(length)
    out = np.repeat(begin - ends + length, length)
    out += np.arange(len(out))
    return out


class _Words:
    """The ids of single words, each encoded once while it is kept."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(tokenizer)
        self.merges = self.encoder.model.tokenize
        self.kind = np.uint16 if self.encoder.get_vocab_size() <= 1 << 16 else np.uint32
        self.young, self.old = _Generation(self.kind), _Generation(self.kind)

    def _encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word. Words of a-z pass the normaliser unchanged and uncut: for them the merges are all there is to do."""
        out = [[t.id for t in self.merges(w.decode())] if w.isalpha() and w.islower() else [] for w in words]
        rest = [i for i, ids in enumerate(out) if not ids]
        for i, e in zip(rest, self.encoder.encode_batch_fast([words[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the words data[start:end]: where in ``young.ids`` those of each begin, and how many they are."""
        h, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if self.young.bytes() > CACHED_BYTES // 2:
            self.young, self.old = _Generation(self.kind), self.young
        missing = np.flatnonzero(self.young.find(h)[0] < 0)
        if len(missing):
            begin, length = self.old.find(h[missing])
            known = begin >= 0
            self.young.add(h[missing[known]], length[known], self.old.ids[_spread(begin[known], length[known])])
            fresh = missing[~known]
            raw = data.tobytes()
            found = self._encode([raw[a:b] for a, b in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist(), strict=True)])
            self.young.add(h[fresh], np.array([len(x) for x in found], np.int64), np.array([i for x in found for i in x], self.kind))
        begin, length = self.young.find(h)
        return begin[which], length[which]


#: By tokenizer file; a worker keeps its words over its tasks.
_known: dict[str, _Words] = {}


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and the text of each. A comma or full stop after an ASCII letter or digit is a word of its own: the tokenizer cuts there anyway."""
    starts, ends, doc = word_spans(data, offsets)
    last = data[ends - 1]
    cut_off = ((last == 44) | (last == 46)) & (ends - starts > 1) & _ALNUM[data[np.maximum(ends - 2, 0)]]
    at = np.flatnonzero(cut_off)
    more = np.repeat(np.arange(len(starts)), 1 + cut_off)
    starts, ends, doc = starts[more], ends[more], doc[more]
    mark = at + np.arange(len(at)) + 1
    starts[mark] = ends[mark] - 1
    ends[mark - 1] -= 1
    return starts, ends, doc


def _ids(data: np.ndarray, offsets: np.ndarray, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts of a block, one after the other, and where each text's begin and end. Only distinct words are looked up. A-Z are lower-cased, as the tokenizer does, unless the block could hold a special token, which is told by case."""
    data = data if b"<|" in data.tobytes() else _LOWER[data]
    starts, ends, doc = _split(data, offsets)
    begin, length = words.places(data, starts, ends)
    sums = np.concatenate([[0], np.cumsum(length)])
    return words.young.ids[_spread(begin, length)].astype("<u4"), sums[np.searchsorted(doc, np.arange(len(offsets)))]


def _pieces(tokenizer: str, size: int, end_id: int):
    def run(batches):
        import pyarrow as pa

        if tokenizer not in _known:
            _known[tokenizer] = _Words(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in (b.slice(at, _BATCH) for b in batches for at in range(0, b.num_rows, _BATCH)):
            docs = batch.column("doc_id").to_pylist()
            for first, data, bounds in text_blocks(batch.column("text"), _BLOCK):
                ids, offsets = _ids(data, bounds, _known[tokenizer])
                out: list[list] = [[], [], [], [], []]
                for doc, a, b in zip(docs[first : first + len(bounds) - 1], offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    own = ids[a:b].tobytes() + end
                    for k, at in enumerate(range(0, len(own), 4 * size)):
                        part = own[at : at + 4 * size]
                        for column, value in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _TYPES(), strict=True)], _NAMES)
        pa.default_memory_pool().release_unused()

    return run


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _TYPES():
    import pyarrow as pa

    return [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Per piece of at most ``size`` tokens: doc_id, piece, start, length, ids_crc32 (of the little-endian 32-bit ids).

    The ids of a text are those of ``tokenizer`` without special tokens, then ``end_id``; null texts are empty. The tokenizer
    must lower case and cut at white space and marks before it merges, so that words can be encoded once per worker.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pieces(tokenizer, size, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, tokens: int, documents: int, attention: float, weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of items of the given lengths, longest first.

    An item demands (length, 1, length**2) of the capacities (tokens, documents, attention). Among the open bins where all
    three fit, ``rule`` "norm" takes the least weighted norm of what would be left, and "dot" the least weighted dot product
    of demand and residual; shares of the capacities are compared. Without such a bin a new one is opened. An item that by
    itself exceeds the attention capacity gets a bin of its own.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    capacity = np.array([tokens, documents, attention], float)
    w = np.array(weights, float)
    shortest = np.minimum.accumulate(lengths[order][::-1])[::-1] if len(order) else lengths
    left = np.zeros((3, 64))
    label = np.zeros(64, np.int64)
    n = made = 0
    for rank, i in enumerate(order):
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2])
        share = need / capacity
        fits = np.flatnonzero((left[0, :n] >= share[0] - 1e-12) & (left[1, :n] >= share[1] - 1e-12) & (left[2, :n] >= share[2] - 1e-12))
        if len(fits):
            open_ = left[:, fits]
            cost = w @ (open_ - share[:, None]) ** 2 if rule == "norm" else (w * share) @ open_
            at = int(fits[np.argmin(cost)])
        else:
            if n == left.shape[1]:
                left, label = np.concatenate([left, np.zeros_like(left)], axis=1), np.concatenate([label, np.zeros_like(label)])
            at, left[:, n], label[n] = n, 1.0, made
            n, made = n + 1, made + 1
        bins[i], offsets[i] = label[at], round((1.0 - left[0, at]) * tokens)
        left[:, at] -= share
        if left[0, at] * tokens < shortest[rank] - 1e-6 or left[1, at] * documents < 1 - 1e-6 or left[2, at] <= 0:
            n -= 1
            left[:, at], label[at] = left[:, n], label[n]
    return bins, offsets


def pack(pieces: DataFrame, size: int = 2048, documents: int | None = None, attention: float | None = None, weights: tuple[float, float, float] = (1.0, 0.1, 0.1), rule: str = "norm", shard_rows: int = 8192) -> DataFrame:
    """``pieces`` (a column length, at most ``size``) with sequence_id and offset.

    Pieces are dealt at random, by hash, to shards of about ``shard_rows``, repeated ones too; each shard is packed by itself with best_fit, so a
    task holds one shard whatever the input's size, and sharding costs at most a few sequences in a shard. All three residuals
    weigh in the choice of a bin. The default capacities of documents and attention (``size`` and ``size**2``) are met by whatever fits by
    tokens, as the aim is few sequences; lower ones bind like the tokens do.
    """
    documents, attention = documents or size, attention or float(size) ** 2
    rows = pieces.count()
    shards = max(1, -(-rows // shard_rows))
    names = pieces.columns
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(*[F.col(c) for c in names], F.monotonically_increasing_id()), F.lit(shards)))

    def run(frame):
        length = frame["length"].to_numpy()
        bins, offsets = best_fit(length, size, documents, attention, weights, rule)
        return frame.assign(sequence_id=frame["shard"].to_numpy() * (1 << 24) + bins, offset=offsets)[[*names, "sequence_id", "offset"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"
    return dealt.groupBy("shard").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, **how) -> DataFrame:
    """Per piece of the documents (doc_id, text; other columns are ignored): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Longer documents are cut into pieces of ``size`` tokens; nothing else is cut. Null and empty texts have the end id alone.
    Repeated rows are packed each; an empty table gives no rows; a null doc_id is carried along. A very long text is tokenised
    as a block of its own. Bins that tie are taken in the order in which they were opened.
    """
    return pack(cut(token_pieces(docs, tokenizer, size, end_id)), size, **how)
