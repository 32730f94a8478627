"""Near-duplicate vectors by a pivot-permutation index: ordered nearest reference points, inverted lists, verification."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import cut, mix
from tallyflow.llm.components import connected_components

#: Vectors that one side of a comparison holds at most.
BLOCK = 1024
#: Cosine that two reference points stay below, and draws of reference points at most.
APART, DRAWS = 0.8, 8


def reference_count(rows: int) -> int:
    """Reference points for an index of ``rows`` vectors. The possible sets of three of them grow in proportion to the rows, so that the inverted lists of unrelated vectors keep their length at every size."""
    return max(16, int(round(7 * rows ** (1 / 3))))


def thinned(kept: np.ndarray, unit: np.ndarray, most: int, step: int = 256) -> np.ndarray:
    """``kept`` with those of the ``unit`` vectors, in order, whose cosine to each one before them is below APART, ``most`` in all."""
    for a in range(0, len(unit), step):
        some = unit[a : a + step]
        some = some[(some @ kept.T < APART).all(axis=1)]
        alike, new = some @ some.T >= APART, []
        for i in range(len(some)):
            if not alike[i, new].any():
                new.append(i)
        kept = np.concatenate([kept, some[new]])[:most]
        if len(kept) == most:
            break
    return kept


def scaled(lists: list) -> np.ndarray:
    """The vectors as rows, each divided by a power of two, so that its largest component is about 1: cosines stay as they are, and no norm overflows or vanishes."""
    raw = np.array(lists, float)
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1]) if len(raw) else raw


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _apart_from(references: np.ndarray):
    """The usable rows that no reference point is near to."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("embedding").to_pylist()
            good = np.array([i for i, x in enumerate(lists) if len(x) == references.shape[1]], int)
            unit = _unit(scaled([lists[i] for i in good]).reshape(len(good), references.shape[1]))
            yield batch.take(pa.array(good[(unit @ references.T < APART).all(axis=1)], pa.int64()))

    return run


def reference_points(usable: DataFrame, most: int, drawn: int, seed: int) -> np.ndarray:
    """At most ``most`` unit vectors of ``usable`` (vec_id, embedding) in the order of a hash of their id, no two with a cosine of APART or more.

    So a group of near copies supplies one or a few points, whatever its share of the rows, and its members agree on most of
    the others. ``drawn`` rows are taken at a time; after the first time from those that no point is near to yet.
    """
    points = None
    for _ in range(DRAWS):
        rest = usable if points is None else usable.mapInArrow(_apart_from(points), usable.schema)
        chosen = rest.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(drawn).toPandas()["embedding"]
        if points is None:
            points = np.zeros((0, chosen.map(len).mode()[0]))
        rows = [x for x in chosen if len(x) == points.shape[1]]
        points = thinned(points, _unit(scaled(rows).reshape(len(rows), points.shape[1])), most)
        if len(points) == most or len(chosen) < drawn:
            break
    return points


def nearest_points(unit: np.ndarray, references: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of each vector's nearest reference points, nearest first; equal cosines by number."""
    cosines = unit @ references.T
    near = np.sort(np.argpartition(-cosines, nearest - 1, axis=1)[:, :nearest], axis=1)
    order = np.argsort(-np.take_along_axis(cosines, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1)


def _key(points: np.ndarray) -> np.ndarray:
    """The inverted list of each row's points, given in the order of their numbers."""
    key = np.zeros(len(points), np.uint64)
    for k in range(points.shape[1]):
        key = mix(key + points[:, k].astype(np.uint64) + np.uint64(1))
    return key.astype(np.int64)


def meeting_key(left: np.ndarray, right: np.ndarray, shared: int) -> np.ndarray:
    """The one list of all those that two permutations share to which the pair belongs: that of the ``shared`` common points with the least sum of ranks, equal sums by number."""
    width = left.shape[1]
    ranks = np.full(left.shape, 2 * width, np.int64)
    for k in range(width):
        same = left[:, k][:, None] == right
        ranks[:, k] = np.where(same.any(axis=1), k + same.argmax(axis=1), 2 * width)
    order = np.argsort(ranks * (1 << 32) + left, axis=1)[:, :shared]
    return _key(np.sort(np.take_along_axis(left, order, axis=1), axis=1))


def _permutations(references: np.ndarray, nearest: int, shared: int):
    subsets = np.array(list(combinations(range(nearest), shared)))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("embedding").to_pylist()
            good = np.array([i for i, x in enumerate(lists) if len(x) == references.shape[1]], int)
            rows = scaled([lists[i] for i in good]).reshape(len(good), references.shape[1])
            near = nearest_points(_unit(rows), references, nearest) if len(good) else np.zeros((0, nearest), int)
            ordered = np.sort(near, axis=1)
            keys = np.stack([_key(ordered[:, s]) for s in subsets], axis=1) if len(good) else np.zeros((0, len(subsets)), np.int64)
            take = pa.array(good, pa.int64())
            packed = [pa.array([x.tobytes() for x in rows], pa.binary()), pa.array([x.astype("<i4").tobytes() for x in near], pa.binary()), pa.array(keys.tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(take), batch.column("n").take(take), *packed], ["vec_id", "n", "vector", "near", "keys"])

    return run


def _roots(n: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Least index of each index's component."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, rows, root[columns])
        np.minimum.at(low, columns, root[rows])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _compare(threshold: float, shared: int):
    """From rows of (key, lo, hi, part, vec_id, n, vector, near) in the order of (key, lo, hi): for each pair of blocks, the links that belong to this key, as counts for each vector (one that stands for n equal ones counts n times) and an edge to a vector of its component."""

    def links(ids, parts, weights, vectors, near, key, lo, hi):
        left, right = (np.flatnonzero(parts == lo), np.flatnonzero(parts == hi))
        if not len(left) or not len(right):
            return
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        found = []
        for a in range(0, len(left), 256):
            rows = left[a : a + 256]
            i, j = np.nonzero(unit[rows] @ unit[right].T >= threshold - 1e-9)
            i, j = rows[i], right[j]
            if lo == hi:
                i, j = i[i < j], j[i < j]
            exact = (vectors[i] * vectors[j]).sum(axis=1) / (np.sqrt((vectors[i] * vectors[i]).sum(axis=1)) * np.sqrt((vectors[j] * vectors[j]).sum(axis=1))) >= threshold
            i, j = i[exact], j[exact]
            if len(i):
                mine = meeting_key(near[i], near[j], shared) == key
                found.append((i[mine], j[mine]))
        if not found:
            return
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        n = np.bincount(np.concatenate([i, j]), np.concatenate([weights[j], weights[i]]), minlength=len(ids)).astype(np.int64)
        root = _roots(len(ids), i, j)
        some = np.flatnonzero(n)
        yield ids[some], n[some], ids[root[some]]

    def run(batches):
        import pyarrow as pa

        held: list = []

        def flush():
            if len(held) < 2:
                return
            ids = np.array([h[0] for h in held])
            parts = np.array([h[1] for h in held])
            weights = np.array([h[2] for h in held], np.int64)
            vectors = np.frombuffer(b"".join(h[3] for h in held), float).reshape(len(held), -1)
            near = np.frombuffer(b"".join(h[4] for h in held), "<i4").reshape(len(held), -1)
            yield from links(ids, parts, weights, vectors, near, *group)

        def table(out):
            a, b, c = ([np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], ["id", "n", "other"])

        group = None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("key", "lo", "hi", "vec_id", "part", "n", "vector", "near")]
            for key, lo, hi, *row in zip(*columns, strict=True):
                if group != (key, lo, hi):
                    out += flush()
                    held, group = [], (key, lo, hi)
                held.append(row)
            yield table(out)
        yield table(list(flush()))

    return run


def embedding_dedup(vectors: DataFrame, threshold: float = 0.95, nearest: int = 6, shared: int = 3, sample: int = 16_384, seed: int = 11) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding; other columns are ignored): vec_id, n_links, component_id, kept.

    1. Reference points are vectors of the table: the first by a hash of their id, ``reference_count`` of the rows and at most
       ``sample``, a bounded part. They are thinned so that no two are close. Where only few such points are, lists are
       longer and more pairs are compared; no link is lost by it.
    2. Equal vectors are one class (128-bit hash), so that a hot group of copies never meets pair by pair. Every class is
       described by its ``nearest`` reference points, nearest first. Two are compared if they share at least ``shared`` of
       them: the inverted lists are kept by sets of ``shared`` points, so that sharing so many means to meet in a list. The
       share of links found so is measured in the tests.
    3. Lists with over 1024 vectors are split into blocks, and pairs of blocks go to different tasks; no pair is written out.
       A pair counts only in the list of its common points with the least ranks. Cosines are computed in double precision from
       the vectors, scaled by powers of two, and links are those of at least ``threshold``.
    4. Tasks hand on, for each vector, its number of links and one edge to its component; the rest is star contraction.

    Vectors that are null, zero, of another length than most, or with null or non-finite components link with
    nothing; very large and very small ones link like any others. Rows of a repeated vec_id count as one vector, the least. A null vec_id stays alone.
    An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = rows.where("vec_id is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(embedding, x -> x != 0)")
    n = usable.count()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if n < 2:
        return alone
    most = min(sample, reference_count(n))
    points = reference_points(usable, most, min(sample, 2 * most), seed)
    if not len(points):
        return alone
    nearest = min(nearest, len(points))
    shared = min(shared, nearest)
    hashes = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    single = cut(usable.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).select("vec_id", "embedding", *hashes))
    classes = cut(single.groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("n")))
    of_each = classes.select(F.col("first").alias("vec_id"), "n")
    described = cut(single.join(of_each, "vec_id").select("vec_id", "n", "embedding").mapInArrow(_permutations(points, nearest, shared), "vec_id long, n long, vector binary, near binary, keys array<long>"))
    lists = described.select(F.explode("keys").alias("key"), "vec_id")
    long = cut(lists.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")).withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int"))
    parted = lists.join(long, "key").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    met = parted.select("key", "vec_id", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select("key", "vec_id", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    met = met.join(described.select("vec_id", "n", "vector", "near"), "vec_id").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    found = cut(met.mapInArrow(_compare(threshold, shared), "id long, n long, other long"))
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    components = connected_components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    first = classes.join(links.withColumnRenamed("id", "first").withColumnRenamed("n", "links"), "first", "left").join(components.withColumnRenamed("id", "first"), "first", "left")
    first = first.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "first").alias("component"))
    known = single.select("vec_id", "h1", "h2").join(first, ["h1", "h2"]).select("vec_id", "links", "component")
    joined = rows.select("vec_id").join(known, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
