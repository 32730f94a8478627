"""Helpers that several operators share: lineage cuts, size-checked joins, word and shingle arithmetic."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Separators of words: space and U+0009 to U+000D; all other characters belong to words.
WORD_SPACE = r"[\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Holds the session's Arrow batches to ``most`` bytes: a task keeps several copies of one in its two processes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > most or int(spark.conf.get(key).rstrip("b")) <= 0:
        spark.conf.set(key, str(most))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session: the one already set, else ``spark.checkpoint.dir``, else (local runs only) a temporary folder. Every operator asks for it, so batches are held small here."""
    small_batches(spark)
    context = spark.sparkContext
    if (current := context.getCheckpointDir()) is not None:
        return current
    configured = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tallyflow-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder, so that losing an executor does not replay its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _width(column, kind: T.DataType):
    """Column: about how many bytes a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        fields = len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 1
        return F.greatest(F.size(column), F.lit(0)) * (8 * fields + 8) + 16
    return F.lit(8 * len(kind.fields) + 8 if isinstance(kind, T.StructType) else 8)


def small_side(df: DataFrame, limit: int = 200_000, most_bytes: int = 32 << 20) -> DataFrame:
    """``df``, hinted for broadcast if it has at most ``limit`` rows of ``most_bytes`` together; beyond that Spark joins it by shuffle. Give it a materialised table."""
    sizes = df.limit(limit + 1).select(sum((_width(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16)).cast("long").alias("b"))
    rows, size = sizes.agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if rows <= limit and size <= most_bytes else df


def let(value, use):
    """Column: ``use`` of ``value``, which is worked out once however often ``use`` names it, also inside its lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text):
    """Column: array of the words of ``text``; null and blank texts give an empty array. Native expressions only."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPACE))


# -- arithmetic on packed bytes, inside tasks ---------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_PRIME, _PRIME_BASE = (1 << 31) - 1, 1_220_703_125
_BLOCK = 1 << 18
_tables: list[np.ndarray] = [np.zeros(0, np.uint64)]
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def reuse_freed() -> None:
    """From now on arrays of up to 16 MB come from memory that this process has freed. Before the first free of a large block, glibc gives back each smaller one and takes it anew, page by page."""
    np.empty(16 << 20, np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers."""
    out = x >> np.uint64(30)
    out ^= x
    out *= np.uint64(0xBF58476D1CE4E5B9)
    shifted = out >> np.uint64(27)
    out ^= shifted
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, and of a base modulo a prime and of its inverse, for n positions at least."""
    if len(_tables[0]) < n:
        n = max(n, _BLOCK + 1)
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _tables[:] = [np.cumprod(up), np.cumprod(down), *(_prime_powers(x, n).astype(np.uint32) for x in (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME)))]
    return _tables


def _prime_powers(base: int, n: int) -> np.ndarray:
    out, known = np.ones(n, np.uint64), 1
    while known < n:  # doubles what is known
        more = min(known, n - known)
        out[known : known + more] = out[:more] * np.uint64(pow(base, known, _PRIME)) % np.uint64(_PRIME)
        known += more
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] (bytes or 16-bit units), equal for equal contents wherever they stand.

    Two polynomials make them, one modulo 2**64 and one modulo a prime: for the first alone, long words of a regular build are
    known that differ and yet have equal hashes.
    """
    up, down, prime_up, prime_down = _powers(len(data) + 1)
    wide = data.astype(np.uint64)
    wide += np.uint64(1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(wide * up[: len(data)], out=sums[1:])
    first = (sums[ends] - sums[starts]) * down[starts]
    wide *= prime_up[: len(data)]
    if len(data) >> (32 - int(data.max(initial=0) + 1).bit_length()):  # else the sum of the terms is below 2**63 as it stands
        wide %= np.uint64(_PRIME)
    np.cumsum(wide, out=sums[1:])
    second = (sums[ends] - sums[starts]) % np.uint64(_PRIME) * prime_down[starts] % np.uint64(_PRIME)
    return mix(first ^ mix(second + (ends - starts).astype(np.uint64) * _ODD))


#: Rows of a batch that are worked on at once, so that copies of texts stay small beside the batch.
SLICE = 512


def text_blocks(column, size: int = _BLOCK, change=None):
    """The texts of an Arrow string array as (first row, bytes, offsets), in blocks of about ``size`` bytes; a longer text is a block of its own. Null texts are empty. ``change``, a function of Arrow arrays, is applied first, some rows at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for low in range(0, len(column), SLICE):
        part = pc.fill_null(column.slice(low, SLICE), "").cast(pa.large_string())
        part = (change(part) if change else part).cast(pa.large_binary())
        _, offsets, data = part.buffers()
        offsets = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(part):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield low + at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in a block, and the text (its index in the block) that each belongs to."""
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = _IS_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(word[:-1] & (first[:-1] | ~np.concatenate([[False], word[:-2]]))) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(word[:-1] & (first[1:] | ~word[1:])) + 1 if len(data) else np.zeros(0, np.int64)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_FIVE = mix(np.arange(1, 6, dtype=np.uint64) * _ODD) | np.uint64(1)


def shingle_sets(column, width: int = 5):
    """For each text of an Arrow string array, in order: the sorted distinct 64-bit hashes of its word shingles after lower-casing A-Z. A text with 1 to width-1 words has its whole sequence as one shingle; one without words has none."""
    for _, data, offsets in text_blocks(column):
        data = _LOWER[data]
        starts, ends, doc = word_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        sums = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for k in range(width):
            sums += mix(hashes[k : k + len(sums)] * _FIVE[k % 5] + np.uint64(k))
        sums = mix(sums)
        for i in range(len(offsets) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= width:
                yield np.unique(sums[a : b - width + 1])
            elif b > a:
                yield mix(mix(hashes[a:b] * _FIVE[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of the universal hashes (a*x+b) of a non-empty set, 32 bits each."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        np.minimum(out, ((a[:, None] * part[None, :] + b[:, None]) >> np.uint64(32)).min(axis=1).astype(np.uint32), out=out)
    return out


def universal(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of n multiply-shift hashes."""
    draws = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _ODD + np.uint64(seed))
    return draws[:n] | np.uint64(1), draws[n:]


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct arrays."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)) or not len(a):
        return False
    merged = np.concatenate([a, b])
    merged.sort()
    both = int(np.count_nonzero(merged[1:] == merged[:-1]))
    return 100 * both >= percent * (len(a) + len(b) - both)


def pairs_at_least(hashes: np.ndarray, counts: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets hold 100 * intersection >= percent * union. hashes: the sets' items, one set after the other, each as often as it likes; counts: how many each has; left, right: numbers of the sets of each pair."""
    values, rank = np.unique(hashes, return_inverse=True)
    n = len(values)
    items = np.repeat(np.arange(len(counts)), counts) * n + rank
    items.sort()
    items = items[np.append(True, items[1:] != items[:-1])[: len(items)]]
    owner, rank = np.divmod(items, n) if n else (items, items)
    sizes = np.bincount(owner, minlength=len(counts))
    first = np.cumsum(sizes) - sizes
    a, b = sizes[left], sizes[right]
    keep = (np.minimum(a, b) * 100 >= percent * np.maximum(a, b)) & (a > 0) & (b > 0)
    some = np.flatnonzero(keep)
    at = 0
    ends = np.cumsum(a[some] + b[some])
    while at < len(some):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BLOCK, "right")))
        pair = some[at:to]
        sets = np.concatenate([left[pair], right[pair]])
        size = sizes[sets]
        place = np.repeat(first[sets] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        keys = np.repeat(np.tile(np.arange(len(pair)), 2), size) * n + rank[place]
        keys.sort()
        both = np.bincount(keys[1:][keys[1:] == keys[:-1]] // n, minlength=len(pair))
        keep[pair] = 100 * both >= percent * (a[pair] + b[pair] - both)
        at = to
    return keep


class Recent:
    """What a function made of the ids met lately, within a bound on the sizes of its results."""

    def __init__(self, make, most: int = 6_000_000):
        self.make, self.most, self.size, self.held = make, most, 0, {}

    def __call__(self, key: int, value: bytes):
        if key not in self.held:
            made = self.make(value)
            self.size += len(value)
            if self.size > self.most:
                self.held.clear()
                self.size = len(value)
            self.held[key] = made
        return self.held[key]
