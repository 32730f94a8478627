"""Near-duplicate documents: many universal hash minima, banding, signature and full-set verification, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import cut, jaccard_at_least, minima, mix, shingle_sets, small_side, universal
from tallyflow.llm.near import connect_buckets

BANDS, ROWS = 32, 4


def _signatures(seed: int):
    a, b = universal(BANDS * ROWS, seed)
    salt = mix(np.arange(BANDS * ROWS, dtype=np.uint64) + np.uint64(seed))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, one, two, signs, bands = [], [], [], [], []
            for s in shingle_sets(batch.column("text")):
                n.append(len(s))
                one.append(int(mix(s).sum().astype(np.int64)) if len(s) else 0)
                two.append(int(np.bitwise_xor.reduce(mix(s + np.uint64(99))).astype(np.int64)) if len(s) else 0)
                if len(s):
                    m = minima(s, a, b)
                    signs.append(m.tobytes())
                    bands.append(mix((mix(m.astype(np.uint64) ^ salt)).reshape(BANDS, ROWS).sum(axis=1)).astype(np.int64))
                else:
                    signs.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n", "f1", "f2", "signature", "bands"])

    return run


def _sets(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(batch.column("text"))], pa.binary())], ["id", "shingles"])


def _similar_signatures(least: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = [np.count_nonzero(np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)) >= least * BANDS * ROWS for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _similar_sets(percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = [jaccard_at_least(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _unpack(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def _with_both(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    left = values.select(F.col("id").alias("b"), F.col(value).alias("sb"))
    right = values.select(F.col("id").alias("a"), F.col(value).alias("sa"))
    return pairs.join(left, "b").join(right, "a").select("a", "b", "sa", "sb")


def minhash_dedup(docs: DataFrame, percent: int = 75, seed: int = 1) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_shingles, component_id, kept.

    Texts are lower-cased in A-Z and cut into words at space and U+0009 to U+000D; a document's set holds its distinct
    five-word shingles (a shorter text: its whole sequence). Documents link if 100 * intersection >= percent * union.

    1. Equal sets form one class (128-bit fingerprint and size), so exact copies never meet pairwise.
    2. Class representatives get 128 minima of multiply-shift hashes in 32 bands of 4; a pair at similarity 0.75 shares a band
       with probability 1 - 5e-6. Representatives that share a band are candidates.
    3. Candidates are dropped if their signatures agree in under 0.5 of the minima (five deviations below 0.75), and links are
       confirmed on the full shingle sets.
    4. Components come from alternating large-star and small-star rounds.

    Null or blank texts have the empty set and link with nothing. Rows without doc_id get a null component_id and stay.
    Repeated rows are one document: each row is returned. An empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut(docs.mapInArrow(_signatures(seed), "doc_id long, n long, f1 long, f2 long, signature binary, bands array<long>"))
    full = signed.where("n > 0 and doc_id is not null")
    classes = cut(full.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("id")))
    first = full.join(classes, ["n", "f1", "f2"]).where("doc_id = id").dropDuplicates(["id"])
    members = first.select(F.explode("bands").alias("bucket"), "id")
    candidates = cut(members.groupBy("bucket").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x != y").select("bucket"))
    members = cut(members.join(candidates, "bucket"))
    wanted = cut(members.select("id").distinct())
    near = small_side(wanted)
    signatures = cut(full.select(F.col("doc_id").alias("id"), "signature").dropDuplicates(["id"]).join(near, "id"))
    sets = cut(docs.where("doc_id is not null").join(near.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").mapInArrow(_sets, "id long, shingles binary").dropDuplicates(["id"]))

    def verify(pairs: DataFrame) -> DataFrame:
        likely = _with_both(pairs, signatures, "signature").mapInArrow(_similar_signatures(0.5), "a long, b long")
        return _with_both(cut(likely), sets, "shingles").mapInArrow(_similar_sets(percent), "a long, b long")

    components = connect_buckets(members, verify, sets.withColumnRenamed("shingles", "value"), _unpack, percent)
    labels = classes.join(components, "id", "left").select("n", "f1", "f2", F.coalesce("component", "id").alias("component_id"))
    out = full.select("doc_id", "n", "f1", "f2").join(labels, ["n", "f1", "f2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    rest = signed.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
