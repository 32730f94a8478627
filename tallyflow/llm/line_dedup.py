"""Line dedup: fuzzy lines by MinHash over character shingles, banding, exact Jaccard verification, union-find over the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import _LOWER, cut, let, mix, pairs_at_least, reuse_freed, small_side, span_hashes, text_blocks
from tallyflow.llm.near import connect_buckets

BANDS, ROWS = 12, 5
BINS = BANDS * ROWS
#: Bytes of text that a step of the arithmetic takes, so that its arrays stay in the processor's cache.
STEP = 1 << 17
#: Characters of a shingle, as UTF-16 units. With five or fewer, unlike lines of one language share so many shingles that false candidates grow out of hand.
WIDTH = 6
_BLANK = np.zeros(1 << 16, bool)
_BLANK[[0x20, 9, 11, 12, 13]] = True


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block of texts as UTF-16 units with A-Z lower-cased, and the offsets of the texts in them."""
    data = _LOWER[data]
    if data.max(initial=0) < 128:
        return data.astype("<u2"), offsets
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace").encode("utf-16-le") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return np.frombuffer(b"".join(texts), "<u2"), np.concatenate([[0], np.cumsum([len(t) // 2 for t in texts])])


def _lines(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the lines of a block without the blanks around them (blank lines are left out), the text of each and its number there."""
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    doc = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, starts)], offsets[doc + 1])
    number = np.arange(len(starts)) - np.searchsorted(doc, doc)
    solid = np.flatnonzero(~_BLANK[data] & (data != 10))
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends) - 1
    some = last >= first
    starts = np.where(some, solid[np.minimum(first, len(solid) - 1)] if len(solid) else starts, starts)
    ends = np.where(some, solid[np.maximum(last, 0)] + 1 if len(solid) else starts, starts)
    return starts[some], ends[some], doc[some], number[some]


def _fours(data: np.ndarray) -> np.ndarray:
    """Four units from each place of an array on, as integers; a view."""
    return np.ndarray(max(0, len(data) - 3), "<u8", data, strides=(2,))


def line_shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of non-empty lines, one line after the other, and how many each has. A shorter line is filled up with 0xFFFF, which is no character, and is its own shingle."""
    counts = np.maximum(ends - starts - WIDTH + 1, 1)
    first = np.cumsum(counts) - counts
    at = np.repeat(starts - first, counts) + np.arange(int(counts.sum()))
    short = np.flatnonzero(ends - starts < WIDTH)
    filled = data
    if len(short):  # their units go behind the others, filled up
        units = np.full((len(short), WIDTH), 0xFFFF, "<u2")
        for k in range(WIDTH - 1):
            some = np.flatnonzero(ends[short] - starts[short] > k)
            units[some, k] = data[starts[short[some]] + k]
        filled = np.concatenate([data, units.ravel()])
        at[first[short]] = len(data) + np.arange(len(short)) * WIDTH
    fours = np.ascontiguousarray(_fours(filled))
    h = mix(fours[: len(fours) - WIDTH + 4])
    h ^= fours[WIDTH - 4 :]
    return mix(h)[at], counts


def signatures(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One-permutation minima of the lines' shingles, a row of BINS for each non-empty line: the hash of a shingle picks its bin and its rank there. An empty bin takes over the next full one, shifted by the distance. A line shorter than a shingle is its own shingle."""
    h, counts = line_shingles(data, starts, ends)
    cell = np.repeat(np.arange(0, len(starts) * BINS, BINS), counts) + ((h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).view(np.int64)
    out = np.full(len(starts) * BINS, 1 << 32, np.uint64)
    np.minimum.at(out, cell, h & np.uint64(0xFFFFFFFF))
    out = out.reshape(-1, BINS)
    full = out < np.uint64(1 << 32)
    rows = np.flatnonzero(~full.all(axis=1))
    if len(rows):
        place = np.arange(BINS, dtype=np.int16)
        ahead = np.where(full[rows], place, np.int16(4 * BINS))
        ahead = np.minimum.accumulate(np.concatenate([ahead, ahead + np.int16(BINS)], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :BINS]
        out[rows] = out[rows[:, None], ahead % BINS] + ((ahead - place).astype(np.uint64) << np.uint64(33))
    return out


def _by_slot(near: bool, slot: np.ndarray, slots: int, columns: list[np.ndarray], most: int = 1 << 22):
    """Rows of 64-bit integers as one value for each slot that has some, ``most`` rows at a time."""
    import pyarrow as pa

    for at in range(0, len(slot), most):
        part = slot[at : at + most]
        order = np.argsort(part.astype(np.uint16) if slots <= 1 << 16 else part, kind="stable")
        counts = np.bincount(part, minlength=slots)
        some = np.flatnonzero(counts)
        rows = np.stack([c[at : at + most][order] for c in columns], axis=1)
        offsets = np.concatenate([[0], np.cumsum(counts[some]) * 8 * len(columns)]).astype(np.int32)
        data = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.repeat(pa.scalar(near), len(some)), data], ["slot", "near", "data"])


def _dealt(slots: int):
    """The lines of texts, packed for the shuffle: (bucket, h) for each band of each line by the bucket's slot, and (h, doc_id, mark, line, n) by that of h.

    A line that the task has met lately has no further bands. n counts equal lines among those packed together and stands at the
    least of them; the others have 0 and go anywhere, so that a frequent line is no hot slot.
    """

    def run(batches):
        reuse_freed()
        met: set[int] = set()
        salt = mix(np.arange(BINS, dtype=np.uint64))
        bands: list = []
        lines: list = []

        def packed():
            h, doc, mark, number = (np.concatenate(x) for x in zip(*lines, strict=True))
            order, first, counts = _grouped(h, doc, mark, number)
            n = np.zeros(len(h), np.int64)
            n[first] = counts
            h, doc, mark, number = h[order], doc[order], mark[order], number[order]
            slot = np.where(n > 0, h.view(np.uint64) % np.uint64(slots), np.arange(len(h), dtype=np.uint64) % np.uint64(slots)).astype(np.int64)
            yield from _by_slot(False, slot, slots, [h, doc, mark, number, n])
            if bands:
                buckets, ids = (np.concatenate(x) for x in zip(*bands, strict=True))
                yield from _by_slot(True, (buckets.view(np.uint64) % np.uint64(slots)).astype(np.int64), slots, [buckets, ids])
            lines.clear()
            bands.clear()

        rows = 0
        for batch in batches:
            ids, marks = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy()
            for at, data, offsets in text_blocks(batch.column("text"), STEP):
                data, offsets = _units(data, offsets)
                starts, ends, doc, number = _lines(data, offsets)
                if not len(starts):
                    continue
                h = span_hashes(data, starts, ends)
                lines.append((h.view(np.int64), ids[doc + at], marks[doc + at], number))
                h, first = np.unique(h, return_index=True)
                new = np.array([x not in met for x in h.tolist()], bool)
                if len(met) > 500_000:
                    met.clear()
                met.update(h[new].tolist())
                h, first = h[new], first[new]
                if len(h):
                    m = mix(signatures(data, starts[first], ends[first]) ^ salt)
                    buckets = mix(m.reshape(len(h), BANDS, ROWS).sum(axis=2)).view(np.int64)
                    bands.append((buckets.ravel(), np.repeat(h.view(np.int64), BANDS)))
                rows += len(doc) + BANDS * len(h)
                if rows > 1_500_000:
                    yield from packed()
                    rows = 0
        if lines:
            yield from packed()

    return run


def _grouped(h: np.ndarray, doc: np.ndarray, mark: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by h and place, where each h begins in it, and how often each occurs."""
    order = np.argsort(h, kind="stable")
    again = h[order]
    again = again[1:] == again[:-1]
    if again.any():  # only these need their places compared
        several = np.concatenate([[False], again]) | np.concatenate([again, [False]])
        some = order[several]
        order[several] = some[np.lexsort((number[some], mark[some], doc[some], h[some]))]
    first = np.flatnonzero(np.concatenate([[True], ~again]))
    return order, first, np.diff(np.append(first, len(h)))


def _gathered(batches):
    """What _dealt packed, gathered by slot: (bucket, id) of buckets with several ids; and each line (id, doc_id, mark, line), with n, the number of lines equal to it, at the least of these alone.

    Of bucket rows what has met is handed on at once and but one id of it is held, so that a task holds a row for each bucket,
    however large a bucket is; of equal lines it holds one.
    """
    import pyarrow as pa

    reuse_freed()
    names = ["bucket", "id", "doc_id", "mark", "line", "n"]
    kinds = [*[pa.int64()] * 4, pa.int32(), pa.int64()]
    held: dict[bool, list[np.ndarray]] = {True: [], False: []}
    rows, limit = {True: 0, False: 0}, {True: 2_000_000, False: 1_000_000}
    least = dict(limit)

    def table(**columns):
        n = len(columns["id"])
        return pa.RecordBatch.from_arrays([pa.array(columns[c]).cast(kind) if c in columns else pa.nulls(n, kind) for c, kind in zip(names, kinds, strict=True)], names)

    def met():
        bucket, ids = np.concatenate(held[True]).T
        order = np.argsort(bucket)
        bucket, ids = bucket[order], ids[order]
        again = bucket[1:] == bucket[:-1]
        several = np.concatenate([[False], again]) | np.concatenate([again, [False]])
        single = np.stack([bucket[~several], ids[~several]], axis=1)
        bucket, ids = bucket[several], ids[several]
        order = np.lexsort((ids, bucket))
        bucket, ids = bucket[order], ids[order]
        fresh = np.ones(len(bucket), bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (ids[1:] != ids[:-1])
        bucket, ids = bucket[fresh], ids[fresh]
        first = np.ones(len(bucket), bool)
        first[1:] = bucket[1:] != bucket[:-1]
        group = np.cumsum(first) - 1
        out = np.bincount(group)[group] > 1 if len(group) else first
        held[True] = [single, np.stack([bucket[first], ids[first]], axis=1)]
        return table(bucket=bucket[out], id=ids[out])

    def equal():
        all_rows = np.concatenate(held[False])
        order, first, _ = _grouped(*all_rows[:, :4].T)
        all_rows = all_rows[order]
        classes = all_rows[first]
        classes[:, 4] = np.add.reduceat(all_rows[:, 4], first)
        others = np.ones(len(all_rows), bool)
        others[first] = False
        held[False] = [classes]
        return lines(all_rows[others])

    def lines(some, n=None):
        return table(id=some[:, 0], doc_id=some[:, 1], mark=some[:, 2], line=some[:, 3], **({} if n is None else {"n": n}))

    for batch in batches:
        more: dict[bool, list[np.ndarray]] = {True: [], False: []}
        for near, data in zip(batch.column("near").to_pylist(), batch.column("data"), strict=True):
            more[near].append(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, 2 if near else 5))
        for near, parts in more.items():
            if not parts:
                continue
            some = np.concatenate(parts)
            if not near:
                other = some[:, 4] == 0
                if other.any():
                    yield lines(some[other])
                some = some[~other]
            held[near].append(some)
            rows[near] += len(some)
            if rows[near] > limit[near]:
                yield met() if near else equal()
                rows[near] = sum(map(len, held[near]))
                limit[near] = max(least[near], 2 * rows[near])
    if held[True]:
        yield met()
    if held[False]:
        yield equal()
        yield lines(held[False][0], held[False][0][:, 4])


def _texts(batches):
    """(id, line) of the wanted lines (line, h) of each document."""
    import pyarrow as pa

    for batch in batches:
        wanted = batch.column("wanted")
        ends, wanted = wanted.value_lengths().to_numpy().cumsum().tolist(), wanted.flatten()
        ids, numbers = wanted.field("h"), wanted.field("line").to_pylist()
        out: list[bytes] = []
        for text, end in zip(batch.column("text").cast(pa.large_binary()), ends, strict=True):
            lines = text.as_py().split(b"\n")
            out += [lines[n].lower().strip(b" \t\x0b\x0c\r") for n in numbers[len(out) : end]]
        yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], ["id", "line"])


def shingles(line: bytes) -> np.ndarray:
    """Sorted distinct shingles of a line of UTF-8."""
    units = np.frombuffer(line.decode("utf-8", "replace").encode("utf-16-le"), "<u2")
    out = np.sort(line_shingles(units, np.array([0]), np.array([len(units)]))[0])
    first = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=first[1:])
    return out[first]


def _similar(percent: int):
    def run(batches):
        import pyarrow as pa

        reuse_freed()
        for batch in batches:
            pairs = list(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "la", "lb")), strict=True))
            keep: list[np.ndarray] = []
            at = 0
            while at < len(pairs):
                numbers: dict[int, int] = {}
                lines: list[bytes] = []
                to = size = 0
                for to in range(at, len(pairs)):
                    a, b, x, y = pairs[to]
                    size += len(x) + len(y)
                    if size > STEP and to > at:
                        break
                    for key, line in ((a, x), (b, y)):
                        if key not in numbers:
                            numbers[key] = len(lines)
                            lines.append(line)
                else:
                    to = len(pairs)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
                units, offsets = _units(np.frombuffer(b"".join(lines), np.uint8), offsets)
                h, counts = line_shingles(units, offsets[:-1], offsets[1:])
                left, right = np.array([(numbers[p[0]], numbers[p[1]]) for p in pairs[at:to]]).T
                keep.append(pairs_at_least(h, counts, left, right, percent))
                at = to
            if keep:
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(np.concatenate(keep)))

    return run


def line_dedup(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with its columns, text without the lines that repeat an earlier one, and n_lines, n_kept; clashing columns of these two names are replaced.

    Lines end at \\n. They are compared without blanks around them and with A-Z lower-cased, as sets of shingles of six
    characters (UTF-16 units, by 64-bit hashes); a shorter line is its own shingle. Lines are linked if 100 * intersection >= percent * union;
    of each component the line with the least (doc_id, text hash, line number) stays. Blank lines always stay.

    Equal lines form one class (64-bit hash). Classes get one-permutation MinHash signatures in 12 bands of 5: at 0.85 a pair
    shares a band with probability 0.999. Candidates are verified on their full shingle sets. Texts are read three times and
    only candidate lines are shuffled, bands and places of lines in packed form; documents move only if those that lose lines are too many to broadcast.

    Null texts stay null with 0 lines. Very long texts and lines take time in proportion to their length. Identical repeated rows are one document and get the same result; rows without doc_id
    come before others. An empty table gives an empty result.
    """
    marked = docs.withColumn("__mark", F.xxhash64("text")).withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    rows = marked.where("text is not null").select(F.col("__id").alias("doc_id"), F.col("__mark").alias("mark"), F.col("text").cast("string").alias("text"))
    slots = 16 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.mapInArrow(_dealt(slots), "slot int, near boolean, data binary").repartition("slot").mapInArrow(_gathered, "bucket long, id long, doc_id long, mark long, line int, n long"))
    place = F.struct("doc_id", "mark", "line")
    lines = dealt.where("bucket is null").select("doc_id", "mark", "line", F.col("id").alias("h"), "n")
    classes = lines.where("n is not null").select("h", place.alias("first"), "n")
    members = cut(dealt.where("bucket is not null").select("bucket", "id").distinct())
    near = cut(members.select(F.col("id").alias("h")).distinct())
    wanted = classes.join(small_side(near), "h").select("first.doc_id", "first.mark", F.struct(F.col("first.line").alias("line"), "h").alias("w"))
    wanted = cut(wanted.groupBy("doc_id", "mark").agg(F.collect_list("w").alias("wanted")))
    texts = cut(rows.join(small_side(wanted), ["doc_id", "mark"]).mapInArrow(_texts, "id long, line binary").dropDuplicates(["id"]))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("id").alias("b"), F.col("line").alias("lb")), "b").join(texts.select(F.col("id").alias("a"), F.col("line").alias("la")), "a")
        return both.select("a", "b", "la", "lb").mapInArrow(_similar(percent), "a long, b long")

    components = connect_buckets(members, verify, texts.withColumnRenamed("line", "value"), shingles, percent).withColumnRenamed("id", "h")
    labelled = classes.join(small_side(components), "h", "left").where("n > 1 or component is not null").withColumn("component", F.coalesce("component", "h"))
    keepers = labelled.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("all")).where(F.col("all") > 1)
    several = labelled.select("h", "component").join(keepers, "component").select("h", "keep")
    dropped = lines.join(several, "h").where(place != F.col("keep")).select("doc_id", "mark", "line").distinct()
    dropped = cut(dropped.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).agg(F.sort_array(F.collect_list("line")).alias("__lines")))
    split = F.split("text", "\n")
    between = lambda parts, k: F.slice(parts, F.coalesce(F.get("__lines", k - 1), F.lit(-1)) + 2, F.coalesce(F.get("__lines", k), F.size(parts)) - F.coalesce(F.get("__lines", k - 1), F.lit(-1)) - 1)
    kept = let(split, lambda parts: F.flatten(F.transform(F.sequence(F.lit(0), F.size("__lines")), lambda k: between(parts, k))))
    size = (F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    joined = marked.join(small_side(dropped), ["__id", "__mark"], "left")
    out = joined.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(size).cast("long")).withColumn("n_kept", F.col("n_lines") - F.coalesce(F.size("__lines"), F.lit(0)))
    out = out.withColumn("text", F.when(F.col("__lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
    return out.select(*[c for c in docs.columns if c not in ("n_lines", "n_kept")], "n_lines", "n_kept")
