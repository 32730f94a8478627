"""Hard negatives against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyflow.llm import hard_negatives as module
from tallyflow.llm.hard_negatives import ThresholdIndex, exact_scores, hard_negatives

KIND = "vec_id long, label int, vector array<long>, anchor boolean"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for a, label, x, anchor in rows:
        if not anchor:
            continue
        score = lambda y: sum(p * q for p, q in zip(x, y))  # noqa: B023, E731
        scored = sorted(((-score(y), v, other) for v, other, y, _ in rows if v != a))
        for s, p, _ in [t for t in scored if t[2] == label][:5]:
            fit = [t for t in scored if t[2] != label and 50 * -s <= 100 * -t[0] <= 95 * -s]
            out += [(a, p, i + 1, t[1], -s, -t[0]) for i, t in enumerate(fit[:3])]
    return sorted(out)


def table(n, width=24, copies=0, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    x = np.floor(40 * (centres[rng.integers(0, 6, n)] + rng.normal(size=(n, width)))).astype(int)
    x[:copies] = x[0]
    return [(i, int(rng.integers(0, 4)) if i >= copies else i % 2, x[i].tolist(), i % 9 == 0) for i in range(n)]


@pytest.mark.parametrize(("copies", "rows"), [(0, 4096), (120, 50), (0, 37)])
def test_equals_all_pairs(spark, monkeypatch, copies, rows):
    monkeypatch.setattr(module, "ROWS", rows)
    monkeypatch.setattr(module, "ANCHORS", max(8, rows // 4))
    data = table(400, copies=copies, seed=rows)
    data += [(1000, None, [1] * 24, True), (1001, 1, None, True), (1002, 1, [None] * 24, True), (None, 1, [1] * 24, True), (1003, 2, [], True), (1004, 2, [5, 5], True), (1005, 77, [3] * 24, True), (1006, 1, [-9] * 24, None)]
    df = spark.createDataFrame(data, KIND).withColumns({c: F.lit("clash") for c in ("part", "parts", "windows", "r", "rank", "anchor_id")})
    got = sorted(tuple(r[c] for c in NAMES) for r in hard_negatives(df).collect())
    assert got == brute(data) and len(got) > 100


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], KIND)
    assert hard_negatives(empty).count() == 0
    data = [(1, 0, [2, 0], True), (1, 0, [2, 0], True), (2, 0, [10, 0], False), (3, 1, [6, 1], False), (3, 1, [6, 1], False), (4, 1, [10, 0], False), (5, 1, [6, 9], False)]
    got = [tuple(r[c] for c in NAMES) for r in hard_negatives(spark.createDataFrame(data, KIND)).orderBy("rank").collect()]
    assert got == [(1, 2, 1, 3, 20, 12), (1, 2, 2, 5, 20, 12)]


def test_the_index_leaves_out_and_finds_all():
    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(size=(900, 40)) * np.geomspace(100, 1, 40))
    anchors = rows[:60] + np.floor(rng.normal(size=(60, 40)) * 5)
    scores = (anchors @ rows.T).astype(int)
    for q in (0.5, 0.99, 0.999):
        thresholds = np.quantile(scores, q, axis=1)
        i, j, s = ThresholdIndex(rows).search(anchors, thresholds)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(scores >= thresholds[:, None])))) and (s == scores[i, j]).all()


def test_large_numbers():
    big = np.array([[float(2**40), 3.0]])
    assert exact_scores(big, np.array([[float(2**20), 1.0]]))[0] == 2**60 + 3
    assert exact_scores(big, big)[0] == 2**63 - 1
