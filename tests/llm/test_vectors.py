"""Links of vectors against brute force."""

import numpy as np

from tallyflow.llm.embedding_dedup import embedding_dedup


def test_recall_with_a_third_near_copies(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=64)
    vectors = rng.normal(size=(1500, 64))
    vectors[:500] = base / np.sqrt((base * base).sum()) + rng.normal(size=(500, 64)) * np.sqrt(0.03 / 64)
    vectors = vectors[rng.permutation(len(vectors))]
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    true = links.sum(axis=1)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = {r.vec_id: r for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    found = np.array([got[i].n_links for i in range(len(rows))])
    assert true.sum() > 100_000 and (found <= true).all()
    assert found.sum() >= 0.9 * true.sum()
    assert len({got[i].component_id for i in range(len(rows)) if true[i]}) == 1


def test_copies_and_extreme_lengths(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 16))
    vectors[100:160] = vectors[0]  # equal ones
    vectors[160:180] = vectors[1] + rng.normal(size=(20, 16)) * 0.02
    vectors[200:220] = vectors[2] * 1e200
    vectors[220:240] = vectors[3] * 1e-200
    size = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / size / np.sqrt(((vectors / size) ** 2).sum(axis=1))[:, None]
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    component = np.arange(300)
    for _ in range(300):
        low = np.array([min([component[i], *component[links[i]]]) for i in range(300)])
        if (low == component).all():
            break
        component = low
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [rows[100], (300, [1.0, 2.0]), (301, None)]
    got = {r.vec_id: r for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [got[i].n_links for i in range(300)] == links.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(300)] == component.tolist()
    assert got[300].n_links == 0 and got[301].kept
