"""Links between the members of hash buckets, without writing out the pairs of a large bucket."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import Recent, cut, jaccard_at_least, reuse_freed, small_side, universal
from tallyflow.llm.components import connected_components

#: Members that one side of a comparison within a large bucket holds at most, and bytes of their values, about.
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Minima of a signature, of which a byte each is kept: unlike minima rarely agree in it, like ones always do.
SIGN = 128


def connect_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame], values: DataFrame, unpack: Callable[[bytes], np.ndarray], percent: int, small: int = 6) -> DataFrame:
    """Components (id, component) of the graph of pairs that share a bucket and hold 100 * intersection >= percent * union.

    members: distinct (bucket, id). values: (id, value), from which ``unpack`` makes the sorted distinct 64-bit items of an id.
    verify: takes distinct pairs (a, b), a < b, and returns those that hold.

    Buckets of up to ``small`` ids are compared in full, larger ones with a pivot at first. What a large bucket holds of
    different components after that is compared exactly, block by block inside tasks, only across components and only in the
    first bucket that a pair shares; edges alone leave the task. Copies thus cost as many rows as there are of them; block
    comparisons are quadratic in the ids of a bucket that are alike but not linked.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("id").alias("h"), "id")).alias("p")).where("n > 1")
    members = cut(members.join(sizes, "bucket").select("bucket", "id", "n", F.col("p.id").alias("pivot")))
    few = members.where(F.col("n") <= small).select("bucket", "id")
    pairs = few.select("bucket", F.col("id").alias("a")).join(few.select("bucket", F.col("id").alias("b")), "bucket").where("a < b").select("a", "b")
    star = members.where(f"n > {small} and id != pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))
    components = cut(connected_components(verify(pairs.union(star).distinct())))
    rest = cut(_mixed(members.where(f"n > {small} and id != pivot").select("bucket", "id").join(components, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))))
    if rest.isEmpty():
        return components
    edges = cut(_compared(rest, values, unpack, percent))
    if edges.isEmpty():
        return components
    forest = components.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    return cut(connected_components(forest.union(edges)))


def _mixed(rest: DataFrame) -> DataFrame:
    """The rows (bucket, id, component) of buckets with several components."""
    several = rest.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("bucket")
    return rest.join(several, "bucket").select("bucket", "id", "component")


def _compared(rest: DataFrame, values: DataFrame, unpack: Callable[[bytes], np.ndarray], percent: int) -> DataFrame:
    weighed = rest.select("bucket", "id").join(values.select("id", F.octet_length("value").cast("long").alias("b")), "id")
    sizes = weighed.groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("b") / BLOCK_BYTES)).cast("int").alias("parts"))
    parted = rest.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met = parted.select("bucket", "id", "component", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select("bucket", "id", "component", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    buckets = rest.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))  # a bucket for each band at most
    signed = values.join(small_side(cut(buckets)), "id").select("id", "value", "buckets").mapInArrow(_signed(unpack), "id long, value binary, buckets array<long>, sign binary")
    met = met.join(signed, "id").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    return met.mapInArrow(_blocks(unpack, percent), "a long, b long")


def _signed(unpack: Callable[[bytes], np.ndarray]):
    """Signatures of the values, worked out once an id, in however many buckets it is."""
    a, b = ((x >> np.uint64(32)).astype(np.uint32) for x in universal(SIGN, 23))
    a |= np.uint32(1)

    def sign(items: np.ndarray) -> bytes:
        """A byte each of the minima of a*x+b, in half the width of the items."""
        items = (items >> np.uint64(32)).astype(np.uint32)
        least = np.full(SIGN, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(items), 1024):
            hashes = a[:, None] * items[i : i + 1024]
            hashes += b[:, None]
            np.minimum(least, hashes.min(axis=1), out=least)
        return (least * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes()

    def run(batches):
        import pyarrow as pa

        reuse_freed()
        for batch in batches:
            signs = [sign(unpack(value.as_py())) for value in batch.column("value")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.binary())], [*batch.schema.names, "sign"])

    return run


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In how many places each signature of ``left`` agrees with each of ``right``."""
    if left.size * len(right) <= 1 << 20:
        return np.count_nonzero(left[:, None] == right, axis=2)
    left, right = left.T.copy(), right.T.copy()
    agree = np.zeros((left.shape[1], right.shape[1]), np.uint8)
    for x, y in zip(left, right, strict=True):
        agree += x[:, None] == y
    return agree


def _blocks(unpack: Callable[[bytes], np.ndarray], percent: int):
    likely = round(SIGN * (percent / 100 - 0.2))
    known = Recent(unpack, 3_000_000)  # ids meet again in other buckets

    def edges(bucket, lo, hi, held):
        root = list({h[1]: None for h in held})
        if len(root) == 1:
            return
        numbers = {c: i for i, c in enumerate(root)}
        label, parts = np.array([numbers[h[1]] for h in held]), np.array([h[2] for h in held])
        left, right = np.flatnonzero(parts == lo), np.flatnonzero(parts == hi)
        signed = np.frombuffer(b"".join([h[6] for h in held]), np.uint8).reshape(-1, SIGN)
        agree = _agreeing(signed[left], signed[right])
        parent = {c: c for c in root}

        def find(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for i, j in zip(*np.nonzero((agree >= likely) & (label[left][:, None] != label[right])), strict=True):
            x, y = left[i], right[j]
            if lo == hi and x >= y:
                continue
            p, q = find(held[x][1]), find(held[y][1])
            if p != q and next(z for z in held[x][4] if z in held[y][5]) == bucket and jaccard_at_least(known(held[x][0], held[x][3]), known(held[y][0], held[y][3]), percent):
                parent[p] = q
                yield held[x][0], held[y][0]

    def run(batches):
        import pyarrow as pa

        reuse_freed()
        held: list = []
        group = None

        def table(found):
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            found: list = []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "lo", "hi", "id", "component", "part", "value", "buckets", "sign")]
            for bucket, lo, hi, id_, component, part, packed, buckets, sign in zip(*columns, strict=True):
                if group != (bucket, lo, hi):
                    if len(held) > 1:
                        found += edges(*group, held)
                    held, group = [], (bucket, lo, hi)
                held.append((id_, component, part, packed, buckets, set(buckets), sign))
            yield table(found)
        if len(held) > 1:
            yield table(list(edges(*group, held)))

    return run
