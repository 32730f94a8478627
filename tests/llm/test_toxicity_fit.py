"""What the toxicity model counts and indexes, and its scores against brute force over all terms."""

import zlib
from collections import Counter

import numpy as np
import pytest

from tallyflow.llm.labelled import training_rows
from tallyflow.llm.toxicity import PULLS, Model, fit, toxicity_scores


def test_only_equal_texts_of_one_label_collapse(spark):
    bad = "you vile rotten scoundrel get lost at once " * 3
    rows = [(i, bad, 1) for i in range(40)] + [(40, bad, 0)]
    rows += [(41 + i, f"report number {i} about harvest{i} weather{i} and trade{i}", 0) for i in range(30)]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    ids = sorted(zip(model.ids.tolist(), model.labels.tolist(), strict=True))
    assert ids[0] == (0, 1.0) and ids[1][1] == 0.0 and len(ids) <= 32


def test_scores_are_those_of_all_terms(spark):
    """Brute force over words as text: every term of every text, every example."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    train = training_rows(docs, labels, "toxic", 0, 5)
    model = fit(train)
    words = {r.doc_id: Counter("".join(c if ord(c) >= 128 or c.isalpha() else " " for c in (r.text or "").lower()).split()) for r in docs.collect()}
    known = {r.doc_id: r.label for r in train.collect()}
    assert model.slope is None and set(model.ids.tolist()) <= set(known)  # too few labels to calibrate
    toxic = [i for i in known if known[i] > 0]
    a = Counter(w for i in known if known[i] > 0 for w in words[i])
    b = Counter(w for i in known if known[i] <= 0 for w in words[i])
    n, prior, s = len(known), len(toxic) / len(known), 10.0
    shrunk = lambda w: np.log((a[w] + s * prior) / (len(toxic) + s) / ((b[w] + s * (1 - prior)) / (n - len(toxic) + s)) * (1 - prior) * (len(toxic) + s) / (prior * (n - len(toxic) + s)))
    space = {w for i in model.ids.tolist() for w in words[i]}
    weight = {w: (np.log((1 + n) / (1 + a[w] + b[w])) + 1) * abs(shrunk(w)) for w in space}

    def vector(i):
        v = {w: (1 + np.log(c)) * weight[w] for w, c in words[i].items() if w in space}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    examples = [(i, vector(i)) for i in model.ids.tolist()]
    for r in toxicity_scores(docs, labels).collect():
        v = vector(r.doc_id)
        cosines = np.round([sum(x * e.get(w, 0.0) for w, x in v.items()) for _, e in examples], 12)
        best = [k for k in np.lexsort((np.arange(len(cosines)), -cosines))[:15] if cosines[k] > 0]
        if best and len(cosines) > 15 and abs(np.sort(cosines)[-15] - np.sort(cosines)[-16]) < 1e-9:
            continue  # a tie that rounding may break either way
        one = PULLS[0]  # too few rows to choose by
        vote = (sum(cosines[k] * (known[examples[k][0]] > 0) for k in best) + one * prior) / (sum(cosines[best]) + one) if best else prior
        assert r.score == pytest.approx(vote, abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_far_neighbours_leave_the_vote_near_the_prior():
    model = Model(np.zeros(0, np.uint64), np.zeros(0), [], 0.1)
    near, far = model.vote(15 * 0.9, 15 * 0.9), model.vote(15 * 0.02, 15 * 0.02)
    assert 0.1 < far < 0.4 < 0.9 < near and model.vote(0.0, 0.0) == pytest.approx(0.1)
    rng = np.random.default_rng(0)
    total = rng.uniform(0.1, 10, 400)
    labels = np.where(rng.random(400) < 0.5, 1.0, -1.0)
    model.calibrate(total, total * np.where(labels > 0, 0.9, 0.05), labels)
    assert model.pull in PULLS and model.slope > 0
