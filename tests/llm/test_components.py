"""Connected components: chains, many tasks, and how many rounds they take."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tallyflow.llm import components


def plain(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    return {x: find(x) for x in parent}


def chains(seed, n=900, length=300):
    draw = random.Random(seed)
    ids = draw.sample(range(-(1 << 40), 1 << 40), n)
    edges = [(ids[i], ids[i + 1]) for i in range(n - 1) if (i + 1) % length]
    draw.shuffle(edges)
    return edges


@pytest.fixture
def rounds(monkeypatch):
    seen = []
    cut = components.cut
    monkeypatch.setattr(components, "cut", lambda df: seen.append(1) or cut(df))
    return seen


def test_long_chains_take_one_round_if_a_task_holds_their_edges(spark, rounds):
    edges = chains(1)
    found = {r["id"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == plain(edges)
    assert len(rounds) <= 3  # the edges, their stars, and the round that finds nothing to change


def test_chains_over_many_tasks(spark, rounds, monkeypatch):
    monkeypatch.setattr(components, "PART", 100)
    monkeypatch.setattr(components, "HELD", 40)
    edges = chains(2) + [(5, 5), (None, 3)] + [(1 << 41, x) for x in range(200)]
    found = {r["id"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert found == plain([e for e in edges if None not in e and e[0] != e[1]])


def test_least_reachable():
    draw = random.Random(3)
    for n in (0, 1, 5, 60, 400):
        edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(n)]
        a, b = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
        got = dict(zip(*(x.tolist() for x in components.least_reachable(a, b)), strict=True))
        assert got == {x: c for x, c in plain(edges).items() if x != c}
