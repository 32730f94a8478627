"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and links between overlapping tokens."""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.bytelevel import load_tokenizer, token_bytes
from tallyflow.llm.common import cut

#: A piece of text that both tokenizers treat alike wherever it stands: white space, then what follows up to a space after a
#: character that is no white space at all. Neither lets a token reach over such a place (``check_pieces``).
PIECE = re.compile(r"\s*\S+(?:[^\S ]\s*\S*)*|\s+")
#: Bytes of aligned pieces that a worker keeps, and rows that are worked on at once.
KEPT, SLICE = 96 << 20, 64


def coalesced(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> np.ndarray:
    """The group of each interval: all sorted by start, a group begins where a start reaches the furthest end before it."""
    order = np.lexsort((side, starts))
    first = np.ones(len(order), bool)
    first[1:] = starts[order][1:] >= np.maximum.accumulate(ends[order])[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    return group


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (index in a, index in b) of overlapping intervals; each side is in order and does not overlap itself."""
    low, high = np.searchsorted(b_ends, a_starts, "right"), np.searchsorted(b_starts, a_ends, "left")
    n = np.maximum(high - low, 0)
    left = np.repeat(np.arange(len(n)), n)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + low[left]


@cache
def _pieces(path: str):
    """The processor of a sentence-piece model and the bytes of each id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return model, [bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]


def check_pieces(path: str) -> None:
    """Fails if the model has a token that may reach over the edge of a PIECE."""
    for name in _pieces(path)[1]:
        text = name.decode(errors="replace")
        if re.search("[^ ] ", text):
            raise ValueError(f"the token {text!r} reaches over a space; this model's texts can't be cut there")


class Aligned:
    """Aligned pieces by number: figures (tokens of A and B, groups, links, whether the bytes agree), groups as text, linked id pairs."""

    def __init__(self, byte_path: str, piece_path: str):
        check_pieces(piece_path)
        self.a, self.a_bytes = load_tokenizer(byte_path), token_bytes(byte_path)
        self.b, self.b_bytes = _pieces(piece_path)
        self.lead = len(self.b.encode("a"))
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.names = [f"{mark}{i}" for mark in ",|;" for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.held = 0
        self.figures = np.zeros((1024, 5), np.int64)
        self.codes, self.bounds = np.zeros(4096, np.uint64), np.zeros(1025, np.int64)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece. What is kept is dropped when it takes too much room; numbers hold until the next call."""
        new = [x for x in dict.fromkeys(pieces) if x not in self.index]
        if new and self.held > KEPT:
            self._clear()
            new = list(dict.fromkeys(pieces))
        if new:
            self._add(new)
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))

    def _add(self, new: list[str]) -> None:
        # one after the other they have the tokens they have apart, but for those that end in white space, or hold the mark of a space
        joined = [x for x in new if not x[-1].isspace() and "▁" not in x]
        self._add_joined(joined)
        for x in new:
            if x not in self.index:
                self._add_joined([x])

    def _add_joined(self, new: list[str]) -> None:
        if not new:
            return
        text = "".join(new)
        raw = text.encode()
        a_list = self.a.encode(text, add_special_tokens=False).ids
        b_list = self.b.encode("a" + text)[self.lead :]  # the letter keeps leading space as it is
        same = b"".join(map(self.a_bytes.__getitem__, a_list)) == b"".join(map(self.b_bytes.__getitem__, b_list)) == raw
        if not same and len(new) > 1:
            self._add_joined(new[: len(new) // 2])
            self._add_joined(new[len(new) // 2 :])
            return
        if not same:
            a_list = b_list = []
        a_ids, b_ids = np.array(a_list, np.int64), np.array(b_list, np.int64)
        a_ends, b_ends = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        a_starts, b_starts = a_ends - self.a_size[a_ids], b_ends - self.b_size[b_ids]
        edges = np.cumsum([len(x.encode()) for x in new])
        ids, starts = np.concatenate([a_ids, b_ids]), np.concatenate([a_starts, b_starts])
        side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
        group = coalesced(starts, np.concatenate([a_ends, b_ends]), side)
        order = np.lexsort((starts, side, group))
        of, side, group = np.searchsorted(edges, starts[order], "right"), side[order], group[order]
        fresh = np.diff(group, prepend=-1) > 0
        left, right = overlaps(a_starts, a_ends, b_starts, b_ends)
        link_of = np.searchsorted(edges, a_starts[left], "right")
        count = lambda x: np.bincount(x, minlength=len(new))
        links = count(link_of)

        joint = np.where(fresh, 2, np.diff(side, prepend=0))  # what stands before a token: comma, bar or semicolon
        written = list(map(self.names.__getitem__, (joint * (len(self.names) // 3) + ids[order]).tolist()))
        cuts = np.searchsorted(of, np.arange(len(new) + 1)).tolist()
        texts = ["".join(written[x:y])[1:] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        base, end = len(self.index), len(self.index) + len(new)
        self.index.update(zip(new, range(base, end), strict=True))
        self.texts += texts
        codes = a_ids[left].astype(np.uint64) * np.uint64(len(self.b_bytes)) + b_ids[right].astype(np.uint64)
        self.figures = _room(self.figures, end)
        self.figures[base:end] = np.stack([count(of[side == 0]), count(of[side == 1]), count(of[fresh]), links, np.full(len(new), same)], axis=1)
        at = int(self.bounds[base])
        self.codes, self.bounds = _room(self.codes, at + len(codes)), _room(self.bounds, end + 1)
        self.codes[at : at + len(codes)] = codes
        self.bounds[base + 1 : end + 1] = at + np.cumsum(links)
        self.held += len(raw) + sum(map(len, texts)) + 8 * len(codes) + 250 * len(new)

    def pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct linked id pairs of some pieces, in order, and how often each is linked."""
        some, times = np.unique(numbers, return_counts=True)
        n = self.bounds[some + 1] - self.bounds[some]
        at = np.arange(n.sum()) + np.repeat(self.bounds[some] - (np.cumsum(n) - n), n)
        codes, where = np.unique(self.codes[at], return_inverse=True)
        return codes, np.bincount(where, np.repeat(times, n), minlength=len(codes)).astype(np.uint64)


def _room(held: np.ndarray, n: int) -> np.ndarray:
    if len(held) >= n:
        return held
    out = np.zeros((max(n, 2 * len(held)), *held.shape[1:]), held.dtype)
    out[: len(held)] = held
    return out


def _packed(codes: np.ndarray, times: np.ndarray) -> bytes:
    import pyarrow as pa

    both = np.stack([np.diff(codes, prepend=np.uint64(0)), times]).astype("<u8")
    return len(codes).to_bytes(8, "little") + pa.compress(both.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow as pa

    n = int.from_bytes(packed[:8], "little")
    raw = np.frombuffer(pa.decompress(packed[8:], 16 * n, "zstd", asbytes=True), np.uint8)
    both = np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(2, n)
    return np.cumsum(both[0]), both[1]


@cache
def _aligned(byte_path: str, piece_path: str) -> Aligned:
    return Aligned(byte_path, piece_path)


def _align(byte_path: str, piece_path: str):
    def run(batches):
        import pyarrow as pa

        known = _aligned(byte_path, piece_path)
        for batch in batches:
            figures, digests, packed = [], [], []
            for low in range(0, batch.num_rows, SLICE):
                texts = batch.column("text").slice(low, SLICE).to_pylist()
                cuts = [PIECE.findall(" " + x) if x else [] for x in texts]
                numbers = known.numbers([p for c in cuts for p in c])
                bounds = np.cumsum([0, *map(len, cuts)])
                for x, y in zip(bounds[:-1], bounds[1:], strict=True):
                    own = numbers[x:y]
                    sums = known.figures[own].sum(axis=0)
                    if x == y or sums[4] < len(own):
                        figures.append((0, 0, 0, 0))
                        digests.append("")
                        packed.append(None)
                    else:
                        figures.append(sums[:4].tolist())
                        digests.append(hashlib.sha256(";".join(map(known.texts.__getitem__, own.tolist())).encode()).hexdigest())
                        packed.append(_packed(*known.pairs(own)))
            columns = [pa.array([f[i] for f in figures], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(packed, pa.binary())], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])

    return run


def _counted(batches):
    """(code, n): in how many of the task's documents each pair is linked."""
    import pyarrow as pa

    waiting, size = [], 0

    def merged(parts):
        codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return codes, np.bincount(where, np.concatenate([n for _, n in parts]), minlength=len(codes)).astype(np.int64)

    def table(codes, n):
        return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n)], ["code", "n"])

    for batch in batches:
        for packed in batch.column("pairs").to_pylist():
            codes, _ = _unpacked(packed)
            waiting.append((codes, np.ones(len(codes), np.int64)))
            size += len(codes)
            if size > 2_000_000:
                waiting = [merged(waiting)]
                size = len(waiting[0][0])
                if size > 1_000_000:  # the shuffle adds up the rest
                    yield table(*waiting[0])
                    waiting, size = [], 0
    if waiting:
        yield table(*merged(waiting))


def _scored(shared):
    """n_best and count_sum from a broadcast of the pairs' counts."""

    def run(batches):
        import pyarrow as pa

        codes, counts, best = shared.value
        for batch in batches:
            out = []
            for packed in batch.column("pairs").to_pylist():
                if packed is None:
                    out.append((0, 0))
                    continue
                own, times = _unpacked(packed)
                at = np.searchsorted(codes, own)
                times = times.astype(np.int64)
                out.append((int(times[best[at]].sum()), int((times * counts[at]).sum())))
            columns = {c: batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            columns |= {c: pa.array([x[i] for x in out], pa.int64()) for i, c in enumerate(("n_best", "count_sum"))}
            yield pa.RecordBatch.from_pydict(columns | {"groups_sha256": batch.column("groups_sha256")})

    return run


def _spread(batches):
    """(row, code, times) for each pair of each document."""
    import pyarrow as pa

    for batch in batches:
        for row, packed in zip(batch.column("row").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
            codes, times = _unpacked(packed)
            yield pa.RecordBatch.from_pydict({"row": pa.array(np.full(len(codes), row)), "code": pa.array(codes.astype(np.int64)), "times": pa.array(times.astype(np.int64))})


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str, most_pairs: int = 4_000_000) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is the byte-level vocabulary of ``byte_path``, B the sentence-piece model of ``piece_path``; both encode a space and the
    whole text. Texts are cut where no token of either reaches over, so that a worker aligns each distinct piece once: all tokens
    of both, sorted by start, form groups that break where a start reaches the furthest end so far; overlapping tokens of a group
    are links. A pair of ids counts once for each document (row) in which it is linked, over the whole table.

    Counts of up to ``most_pairs`` pairs (17 bytes each) are broadcast; more are joined by shuffle, with the same results.
    Each document's pairs pass on packed, counts are added up within tasks first. Null and empty texts, and those whose bytes
    either vocabulary changes, have zeros and an empty digest. Rows that repeat count each; a null doc_id is kept. Very long texts
    are worked on whole, one at a time. An empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kept = cut(rows.mapInArrow(_align(byte_path, piece_path), "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"))
    some = kept.where("pairs is not null")
    pairs = cut(some.select("pairs").mapInArrow(_counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))
    width = len(_pieces(piece_path)[1])
    highest = pairs.groupBy(F.floor(F.col("code") / width).alias("a")).agg(F.max("n").alias("most"))  # a row for each id of A
    pairs = pairs.withColumn("a", F.floor(F.col("code") / width)).join(F.broadcast(highest), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    if pairs.count() <= most_pairs:
        table = pairs.toPandas().sort_values("code")
        shared = docs.sparkSession.sparkContext.broadcast((table["code"].to_numpy(np.uint64), table["n"].to_numpy(np.int64), table["best"].to_numpy(bool)))
        return kept.mapInArrow(_scored(shared), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    found = some.select("row", "pairs").mapInArrow(_spread, "row long, code long, times long").join(pairs, "code")
    sums = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return kept.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
