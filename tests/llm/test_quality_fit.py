"""The fits of the quality operators against plain versions of them: hinge loss, ratios and scores of op3; expectation-maximisation and verdicts of op4."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyflow.llm.quality_nbsvm import HALF, dual_coordinate_descent, feature_sets, fit, log_count_ratios, quality_scores
from tallyflow.llm.quality_rules import FAMILIES, RULES, estimate, posteriors, quality_rules, text_figures


def test_coordinate_descent_minimises_the_hinge_loss():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 8))
    y = np.where(x[:, 0] + 0.5 * rng.normal(size=60) > 0, 1.0, -1.0)
    rows = [(np.arange(8), v) for v in x]
    w = dual_coordinate_descent(rows, y, 8, 1.0, 500, 1)
    loss = lambda w: w @ w / 2 + np.maximum(0, 1 - y * (x @ w)).sum()
    gram, alpha = (x * y[:, None]) @ (x * y[:, None]).T, np.zeros(60)
    step = 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(20_000):  # projected gradient on the dual, by dense arithmetic
        alpha = np.clip(alpha - step * (gram @ alpha - 1), 0, 1.0)
    best = (alpha * y) @ x
    assert loss(w) == pytest.approx(loss(best), rel=1e-3) and np.abs(w - best).max() < 0.02


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(2)
    words = [f"{'Ab' if i % 3 else 'xy'}{'tion' if i % 2 else 'zz9'}{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words[:40] if i % 2 else words[20:], 30)) + ("." if i % 2 else " ###"), i % 2) for i in range(90)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(1000, None), (1001, "")], "doc_id long, text string")
    return rows, docs, spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")


def test_ratios_and_scores_by_dense_arithmetic(spark, texts):
    rows, docs, labels = texts
    train = [(i, t, q) for i, t, q in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    one = np.zeros((len(train), 2 * HALF))
    for k, found in enumerate(feature_sets(pa.array([t for _, t, _ in train]))):
        one[k, found] = 1
    q = np.array([q for *_, q in train])
    high, low = one[q > 0].sum(axis=0) + 1, one[q == 0].sum(axis=0) + 1
    want = np.log(high / high.sum()) - np.log(low / low.sum())
    weights, ratio, slope, offset = fit(spark.createDataFrame(train, "doc_id long, text string, label int"))
    assert np.allclose(ratio, want) and np.allclose(ratio, log_count_ratios(high - 1, low - 1))
    got = {r.doc_id: (r.score, r.held_out, r.predicted) for r in quality_scores(docs, labels).collect()}
    everything = [*[(i, t) for i, t, _ in rows], (1000, ""), (1001, "")]
    for (i, _), found in zip(everything, feature_sets(pa.array([t for _, t in everything])), strict=True):
        dense = np.zeros(2 * HALF)
        dense[found] = ratio[found]
        norm = np.linalg.norm(dense)
        margin = weights[:-1] @ (dense / norm if norm else dense) + weights[-1]
        score = 1 / (1 + math.exp(-max(-30, min(30, slope * margin + offset))))
        assert got[i][0] == pytest.approx(score, abs=1e-9) and got[i][1] == (zlib.crc32(str(i).encode()) % 3 == 1) and got[i][2] == (got[i][0] >= 0.5)
    held = [i for i, _, _ in rows if got[i][1]]
    assert np.mean([got[i][2] == rows[i][2] for i in held]) > 0.9 and got[1000][0] == got[1001][0]


def plain_em(votes: np.ndarray, rounds: int, smooth: float):
    """The same estimate over rows, not patterns; votes: 1, 0 or -1 for none."""
    names = list(RULES)
    members = [[names.index(r) for r in family] for family in FAMILIES]
    bad = np.stack([(votes[:, m] == 0).any(axis=1) for m in members], axis=1)
    belongs = np.concatenate([np.where(bad.any(axis=1), 0.1, 0.9)[:, None], 0.05 + bad], axis=1)
    belongs /= belongs.sum(axis=1, keepdims=True)
    k = belongs.shape[1]
    lean = np.full((k, len(names)), 0.9)
    for c, m in enumerate(members):
        lean[c + 1, m] = 0.1
    for _ in range(rounds):
        priors = (belongs.sum(axis=0) + smooth) / (len(votes) + smooth * k)
        rates = (belongs.T @ (votes == 1) + 2 * smooth * lean) / (belongs.T @ (votes >= 0) + 2 * smooth)
        logs = np.log(priors) + (votes == 1) @ np.log(rates).T + (votes == 0) @ np.log(1 - rates).T
        belongs = np.exp(logs - logs.max(axis=1, keepdims=True))
        belongs /= belongs.sum(axis=1, keepdims=True)
    return priors, rates


def test_patterns_give_what_rows_give():
    rng = np.random.default_rng(5)
    n = len(RULES)
    good = rng.random(3000) < 0.8
    votes = np.where(rng.random((3000, n)) < np.where(good, 0.95, 0.5)[:, None], 1, 0)
    votes[rng.random((3000, n)) < 0.3] = -1
    found, counts = np.unique(votes, axis=0, return_counts=True)
    patterns = [(tuple(None if v < 0 else int(v) for v in p), int(c)) for p, c in zip(found, counts, strict=True)]
    priors, rates = estimate(patterns)
    want = plain_em(votes, 50, 0.5)
    assert np.allclose(priors, want[0], atol=1e-9) and np.allclose(rates, want[1], atol=1e-9)
    every = [tuple(v) for v in np.array(np.meshgrid(*[[0, 1, -1]] * n)).reshape(n, -1).T[:: 37]]
    for v in every:
        p = posteriors(priors, rates, tuple(None if x < 0 else int(x) for x in v))
        joint = [pr * np.prod([r if x == 1 else 1 - r for r, x in zip(rs, v, strict=True) if x >= 0]) for pr, rs in zip(priors, rates, strict=True)]
        assert p == pytest.approx([x / sum(joint) for x in joint], abs=1e-9)


def test_verdicts_follow_the_posterior(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = text_figures(docs).select("*", *[rule().cast("int").alias(f"v_{name}") for name, rule in RULES.items()]).collect()
    votes = np.array([[-1 if r[f"v_{x}"] is None else r[f"v_{x}"] for x in RULES] for r in rows])
    priors, rates = plain_em(votes, 50, 0.5)
    want = {}
    for r, v in zip(rows, votes, strict=True):
        p = posteriors(priors, rates, tuple(None if x < 0 else int(x) for x in v))[0]
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        want[r.doc_id] = (failed, not failed and p >= 0.5, p)
    for r in quality_rules(docs).collect():
        failed, kept, p = want[r.doc_id]
        assert r.base_failed == failed and r.posterior == pytest.approx(p, abs=1e-6) and (r.kept == kept or abs(p - 0.5) < 1e-6)
    assert len(want) == len({r.doc_id for r in rows})
