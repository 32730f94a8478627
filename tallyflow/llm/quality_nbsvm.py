"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, linear hinge loss by dual coordinate descent."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import mix, span_hashes, text_blocks, word_spans
from tallyflow.llm.labelled import bounded, fold, logistic, training_rows

#: Hashed features: half for character 3-grams, half for 3-grams of word shapes.
HALF = 1 << 15


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A small code for each word: case of its first letter and second, kind of its last byte, length class, whether it repeats the word before."""
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    last = data[ends - 1]
    kind = np.where(letter[ends - 1], 0, np.where((last == 46) | (last == 44), 1, np.where((last >= 48) & (last <= 57), 2, 3)))
    length = ends - starts
    second = upper[np.minimum(starts + 1, len(data) - 1)] & (length > 1)
    hashes = span_hashes(data, starts, ends)
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    return ((((upper[starts] * 2 + second) * 4 + kind) * 4 + np.digitize(length, [3, 6, 11])) * 2 + same).astype(np.uint64)


def feature_sets(column):
    """For each text of an Arrow array, in order: its sorted feature ids."""
    flags = np.zeros(2 * HALF, bool)
    for _, data, offsets in text_blocks(column):
        wide = data.astype(np.uint64)
        grams = (mix(wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]) >> np.uint64(49)).astype(np.int64) if len(data) > 2 else np.zeros(0, np.int64)
        starts, ends, doc = word_spans(data, offsets)
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        shape = _shapes(data, starts, ends)
        runs = (mix((shape[:-2] * np.uint64(128) + shape[1:-1]) * np.uint64(128) + shape[2:] + np.uint64(1 << 40)) >> np.uint64(49)).astype(np.int64) + HALF if len(shape) > 2 else np.zeros(0, np.int64)
        for i in range(len(offsets) - 1):
            flags[grams[offsets[i] : max(offsets[i], offsets[i + 1] - 2)]] = True
            flags[runs[bounds[i] : max(bounds[i], bounds[i + 1] - 2)]] = True
            found = np.flatnonzero(flags)
            flags[found] = False
            yield found


def _counts(batches):
    import pyarrow as pa

    totals = np.zeros((2, 2 * HALF), np.int64)
    for batch in batches:
        for label, found in zip(batch.column("label").to_pylist(), feature_sets(batch.column("text")), strict=True):
            totals[int(label > 0), found] += 1
    seen = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(totals[1, seen]), pa.array(totals[0, seen])], ["feature", "high", "low"])


def _features(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([f.astype(np.uint16).tobytes() for f in feature_sets(batch.column("text"))], pa.binary())], ["doc_id", "label", "features"])


def log_count_ratios(high: np.ndarray, low: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    p, q = high + smooth, low + smooth
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, c: float, epochs: int, seed: int) -> np.ndarray:
    """Weights that minimise |w|^2/2 + c * sum of hinge losses (Hsieh and others, 2008). rows: (feature ids, values)."""
    w, alpha = np.zeros(width), np.zeros(len(rows))
    norm = np.array([float(v @ v) for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            if not norm[i]:
                continue
            new = min(c, max(0.0, alpha[i] - (y[i] * float(w[f] @ v) - 1.0) / norm[i]))
            if new != alpha[i]:
                w[f] += (new - alpha[i]) * y[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3 * c:
            break
    return w


def fit(train: DataFrame, sample: int = 6000, c: float = 4.0, epochs: int = 20, keep: float = 0.9, seed: int = 3) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(weights, ratios, slope, offset). Log-count ratios come from all training rows, the hinge-loss fit from at most ``sample`` of them: a bounded part of fixed size, drawn and ordered by hash and id, so that the layout of the table does not matter; a fifth of those, by hash of the id, calibrates the scores."""
    counts = train.mapInArrow(_counts, "feature int, high long, low long").groupBy("feature").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toPandas()
    high, low = np.zeros(2 * HALF), np.zeros(2 * HALF)
    high[counts["feature"]], low[counts["feature"]] = counts["high"], counts["low"]
    ratio = log_count_ratios(high, low)
    part = bounded(train, sample, seed).mapInArrow(_features, "doc_id long, label int, features binary").toPandas().sort_values(["doc_id", "features"], kind="stable")
    y = np.where(part["label"].to_numpy() > 0, 1.0, -1.0)
    if not (y > 0).any() or not (y < 0).any():
        return np.zeros(2 * HALF + 1), ratio, 1.0, 30.0 if (y > 0).any() else -30.0 if len(y) else 0.0
    rows = [_scaled(np.frombuffer(f, np.uint16).astype(np.int64), ratio) for f in part["features"]]
    aside = mix(part["doc_id"].to_numpy().astype(np.uint64)) % np.uint64(5) == 4 if len(y) >= 200 else np.zeros(len(y), bool)
    w = dual_coordinate_descent([r for r, x in zip(rows, aside, strict=True) if not x], y[~aside], 2 * HALF + 1, c, epochs, seed)
    w = keep * w + (1 - keep) * np.abs(w).mean()
    use = aside if aside.any() and len(set(y[aside])) == 2 else ~aside
    slope, offset = logistic(np.array([float(w[f] @ v) for (f, v), x in zip(rows, use, strict=True) if x]), y[use])
    return w, ratio, slope, offset


def _scaled(found: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of unit length: indicators times ratios; then a constant feature."""
    v = ratio[found]
    return np.append(found, 2 * HALF), np.append(v / (np.sqrt(float(v @ v)) or 1.0), 1.0)


def quality_scores(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted. Other columns, clashing or not, are ignored.

    Learns ``labels.quality`` from rows whose crc32(doc_id) mod 3 is not 1 and scores every whole text, however long. Null texts are scored as
    empty ones; without labels of both classes every score is 0, 0.5 or 1. Rows without doc_id are scored and not held out.
    Repeated rows are scored each; equal texts get equal scores.
    """
    weights, ratio, slope, offset = fit(training_rows(docs, labels, "quality", 1, 3), **how)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            score = []
            for found in feature_sets(batch.column("text")):
                f, v = _scaled(found, ratio)
                score.append(float(1 / (1 + np.exp(-np.clip(slope * float(weights[f] @ v) + offset, -30, 30)))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double").select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
