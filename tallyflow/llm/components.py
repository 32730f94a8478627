"""Connected components by alternating large-star and small-star rounds (MapReduce and beyond, 2014)."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import cut


def _stars(directed: DataFrame) -> DataFrame:
    """``directed`` (u, v) with m, the least of u and all its v. The minimum is pre-aggregated, so a node with very many links is no hot group; Spark can split the join."""
    least = directed.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
    return directed.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _stars(both).where("v > u and v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = _stars(down)
    linked = stars.select(F.col("v").alias("a"), F.col("m").alias("b")).union(stars.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return linked.where("a != b").distinct()


#: Edges that a task takes at least; rounds over few edges then write few files, however many shuffle partitions there are.
PART = 50_000
#: Edges that a task contracts at once.
HELD = 1_000_000


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of some edges but for the least of each of their components, and that least: (id, least), id > least."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)], place[len(a) :]
    root = np.arange(len(ids))
    while True:
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        apart = np.flatnonzero(low < high)
        if not len(apart):
            break
        u, v = u[apart], v[apart]
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    some = np.flatnonzero(root < np.arange(len(ids)))
    return ids[some], ids[root[some]]


def _contracted(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) with those that a task holds replaced by stars of the same components, each around its least id. Rounds over stars are few, also where edges form long chains."""

    def run(batches):
        import pyarrow as pa

        held: list = []

        def stars():
            columns = [pa.chunked_array([x.column(c) for x in held]) for c in (0, 1)]
            found = least_reachable(*(c.to_numpy() for c in columns))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, c.type) for x, c in zip(found, columns, strict=True)], ["a", "b"])

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:
                yield stars()
                size = 0
        if held:
            yield stars()

    return edges.mapInArrow(run, edges.schema)


def _print_of(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(7)))).first()


#: Up to so many edges a round is planned at once; beyond that Spark plans it again while it runs, as it then splits skewed joins.
PLANNED = 1_000_000


@contextmanager
def _planned_at_once(spark, few: bool, parts: int):
    """Rounds over few edges are many small shuffles; planned one by one, each costs the driver a plan of its own. They get ``parts`` shuffle partitions, as the session's number follows the whole input and most of its tasks would be idle."""
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(key) for key in keys]
    if few:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], str(min(parts, int(before[1]))))
    try:
        yield
    finally:
        for key, value in zip(keys, before, strict=True):
            spark.conf.set(key, value)


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for each node of ``edges`` (a, b): component is the smallest id reachable. Self links and repeated links do no harm; null ends are ignored; no edges give no rows.

    Tasks contract the edges they hold, before and between the rounds, so that what is shuffled is stars. Each round costs two
    shuffles of these; the number of rounds is logarithmic in practice, and one where a task holds all edges. Every round is checkpointed.
    """
    edges = edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut(_contracted(edges).distinct())
    parts = -(-edges.count() // PART)
    if parts:
        edges = cut(_contracted(edges.coalesce(parts)))
        seen = _print_of(edges)
        while True:
            with _planned_at_once(edges.sparkSession, seen[0] <= PLANNED, parts):
                edges = cut(_contracted(_small_star(_large_star(edges).coalesce(parts)).coalesce(parts)))
                now = _print_of(edges)
            if now == seen:
                break
            seen, parts = now, -(-now[0] // PART)
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
