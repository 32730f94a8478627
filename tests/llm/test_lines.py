"""Line dedup against brute force over pairs of lines, and lines of every length."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyflow.llm import common
from tallyflow.llm import line_dedup as line_dedup_module
from tallyflow.llm.line_dedup import WIDTH, line_dedup


def _set(line):
    units = [line.encode("utf-16-le")[i : i + 2] for i in range(0, len(line.encode("utf-16-le")), 2)]
    return frozenset(b"".join(units[i : i + WIDTH]) for i in range(max(1, len(units) - WIDTH + 1)))


def _plain(rows, percent=85):
    """{doc_id: text} by comparing all lines with each other."""
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    lines = [(d, i, x.strip(" \t\x0b\x0c\r").translate(lower)) for d, text in rows for i, x in enumerate((text or "").split("\n"))]
    lines = sorted(x for x in lines if x[2])
    parent = list(range(len(lines)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    sets = [_set(x[2]) for x in lines]
    for a in range(len(lines)):
        for b in range(a):
            if find(a) != find(b) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    gone = {lines[a][:2] for a in range(len(lines)) if find(a) != a}
    return {d: None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (d, i) not in gone) for d, text in rows}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    base = [" ".join(word() for _ in range(rng.choice([1, 1, 4, 20, 40]))) for _ in range(120)] + ["}", "é", "日本語の行", "\U0001f600x"]
    out = []
    for d in range(80):
        lines = []
        for _ in range(rng.randint(0, 9)):
            x = rng.choice(base)
            if rng.random() < 0.4:
                at = rng.randrange(len(x))
                x = x[:at] + rng.choice("xyzé ") + x[at + 1 :]
            lines.append(rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.1 else x))
        out.append((d, "\n".join(lines)))
    hot = "the one line that a great many documents of this table have in common with each other " * 2
    return [*out, (80, None), (81, ""), (82, " \n\n"), *[(100 + i, f"{hot}{i % 7}\nown line number {i} of {word()} {word()} {word()} {word()}") for i in range(60)]]


def test_against_brute_force(spark, rows):
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == _plain(rows)


def test_a_long_document(spark):
    text = "\n".join(f"{i % 500} {i % 500 * 7919 % 10007} {'abcdefghij'[i % 10] * 30}" for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    line_dedup(docs.select("doc_id", F.substring("text", 1, 1000).alias("text"))).count()
    began = time.time()
    r = line_dedup(docs).first()
    assert r.n_lines == 100_000 and r.n_kept <= 500 and r.n_kept == len(r.text.split("\n"))
    assert time.time() - began < 90


def test_pairs_of_sets_in_bulk_are_those_one_by_one():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 40, rng.integers(0, 60)).astype(np.uint64) * np.uint64(1 << 58) for _ in range(60)] + [np.arange(300_000, dtype=np.uint64)] * 2
    left, right = (rng.integers(0, 62, 2_000) for _ in range(2))
    keep = common.pairs_at_least(np.concatenate(sets), np.array([len(x) for x in sets]), left, right, 60)
    assert keep.tolist() == [common.jaccard_at_least(np.unique(sets[a]), np.unique(sets[b]), 60) for a, b in zip(left, right, strict=True)]
    assert 0 < keep.sum() < len(keep)


def test_one_pass_deals_bands_and_lines_and_counts_equal_lines_once():
    import pyarrow as pa

    texts = [f"alpha beta gamma {i % 50}\nthe very frequent line\n\nanother line number {i}\nthe very frequent line" for i in range(400)] + [None, ""]
    rows = pa.table({"doc_id": pa.array(range(402), pa.int64()), "mark": pa.array(range(7, 409), pa.int64()), "text": texts})
    parts = [b for k in range(0, 402, 67) for b in line_dedup_module._dealt(16)(iter(rows.slice(k, 67).to_batches()))]
    assert sum(b.num_rows for b in parts) <= 6 * 2 * 16  # not a row for each band of each line
    dealt = pa.Table.from_batches(parts).to_pylist()
    out = []
    for slot in range(16):
        some = [r for r in dealt if r["slot"] == slot]
        if some:
            batch = pa.RecordBatch.from_pylist(some, parts[0].schema)
            out += [r for b in line_dedup_module._gathered(iter([batch.slice(0, 3), batch.slice(3)])) for r in b.to_pylist()]
    lines = [r for r in out if r["bucket"] is None]
    assert sorted((r["doc_id"], r["mark"], r["line"]) for r in lines) == sorted((i, i + 7, n) for i in range(400) for n in (0, 1, 3, 4))
    classes = [r for r in lines if r["n"] is not None]
    assert sorted(r["n"] for r in classes) == [1] * 400 + [8] * 50 + [800] and len({r["id"] for r in classes}) == 451
    assert {(r["doc_id"], r["line"]) for r in classes if r["n"] > 1} == {(i, 0) for i in range(50)} | {(0, 1)}
    members = [(r["bucket"], r["id"]) for r in out if r["bucket"] is not None]
    ids = {}
    for bucket, i in members:
        ids.setdefault(bucket, set()).add(i)
    assert members and all(len(x) > 1 for x in ids.values()) and {i for _, i in members} <= {r["id"] for r in classes}
