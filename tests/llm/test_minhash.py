"""Near-duplicate documents against brute force over all pairs."""

import random

from tallyflow.llm.minhash_dedup import minhash_dedup


def _sets(rows):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    out = {}
    for i, text in rows:
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(lower)) if x]
        out[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def _plain(rows):
    """{doc_id: (n_shingles, component_id)}."""
    sets = _sets(rows)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in ids:
        for b in ids:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rng = random.Random(4)
    hot = [f"w{rng.randrange(300)}" for _ in range(120)]
    for i in range(150):  # a hot group: chains of near copies, and some that only look alike
        words = list(hot)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        rows.append((10_000 + i, " ".join(words)))
    rows += [(20_000, None), (20_001, ""), (20_002, "one two"), (20_003, "ONE  two\n")]
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    rows += [(20_010, "".join("ab"[b] for b in bits) + " b c d e f"), (20_011, "".join("ba"[b] for b in bits) + " b c d e f")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == _plain(rows)
