"""Places of the mixed blocks in the output shards."""

from collections import Counter

from pyspark.sql import functions as F

from tallyflow.llm.mixing import mix_documents, mix_shares


def test_blocks_have_places_in_shards(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(37 + i % 50)), "abc"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    shares = mix_shares(docs, block=8, shard_slots=64).collect()
    at: dict = {}
    for r in shares:
        assert sum(p.words for p in r.places) == r.taken
        for p in r.places:
            at.setdefault((p.shard, p.slot), set()).add("abc"[r.doc_id % 3])
    assert all(len(x) == 1 for x in at.values())
    shards = sorted({a for a, _ in at})
    assert shards == list(range(len(shards))) and len(shards) > 10
    for shard in shards[:-1]:
        assert sorted(b for a, b in at if a == shard) == list(range(64))
    counts = [tuple(sorted(Counter(min(x) for (a, _), x in at.items() if a == s).items())) for s in shards[:-1]]
    assert len(set(counts)) > 5
    mixed = mix_documents(docs, block=8, shard_slots=64, places=True).collect()
    got = Counter((r.doc_id, p.shard, p.slot, p.words) for r in mixed for p in r.places)
    assert got == Counter((r.doc_id, p.shard, p.slot, p.words) for r in shares for p in r.places)
    assert all(len(r.text.split()) == sum(p.words for p in r.places) for r in mixed)


def test_reruns_over_other_layouts_agree(spark):
    rows = [(i % 90 if i % 7 else None, " ".join(f"w{(i * 7) % 40}x{k}" for k in range(5 + (i * 13) % 60)), ["a", "a", "a", "b", None][i % 5]) for i in range(600)]
    rows += rows[:20] + [(1, None, "a"), (2, "", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def result(df):
        return Counter((r.doc_id, r.size, r.source_size, r.target, r.taken, tuple(map(tuple, r.places))) for r in mix_shares(df, block=16, shard_slots=32).collect())

    first = result(docs.repartition(1))
    assert result(docs.repartition(7)) == first == result(docs.orderBy("text"))
    sizes: dict = {}
    for (_, size, source_size, target, taken, _), n in first.items():
        assert taken <= 2 * size
        x = sizes.setdefault((source_size, target), [0, 0])
        x[0] += n * size
        x[1] += n * taken
    assert all(size == source_size and abs(taken - target) <= 32 for (source_size, target), (size, taken) in sizes.items())


def test_permutations(spark):
    from pyspark.sql import functions as F

    from tallyflow.llm.mixing import permuted

    for n in (1, 2, 3, 7, 64, 65, 1000):
        got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5))).collect()]
        assert sorted(got) == list(range(n)) and (n < 50 or got != list(range(n)))


def test_small_sources_beside_a_huge_one_meet_their_targets(spark):
    rows = [(i * 4 + k, " ".join(f"w{j}" for j in range(30)), f"s{i:02d}") for i in range(30) for k in range(4)]
    rows += [(1000 + i, " ".join(f"v{j}" for j in range(500)), "t") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken: dict = {}
    of = {i: s for i, _, s in rows}
    for r in mix_shares(docs).collect():
        x = taken.setdefault(of[r.doc_id], [r.target, 0])
        x[1] += r.taken
    assert all(abs(t - n) <= max(1.5, 0.01 * t) for t, n in taken.values()), taken


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, f"one two three {i} " * 20, "ab"[i % 2], 7) for i in range(40)], "doc_id long, text string, source string, n_chars int")
    clash = docs.withColumns({c: F.lit("own") for c in ("mark", "parts", "places", "width", "block", "size", "start", "words", "shard", "chunk", "copy")})
    got, plain = mix_documents(clash, places=True), mix_documents(docs, places=True)
    assert sorted(got.columns) == sorted(clash.columns) and got.select("mark").distinct().first()[0] == "own"
    key = lambda df: sorted((r.doc_id, r.text, r.n_chars, str(r.places)) for r in df.collect())
    assert key(got) == key(plain) and len(key(plain)) > 0
    assert mix_documents(clash.where("false"), places=True).count() == 0


def test_texts_are_shuffled_once(spark):
    """Equal rows, with and without id or source, are told in the join's own shuffle and order, not by an aggregate that sorts whole texts before."""
    rows = [(i % 50 if i % 7 else None, f"w{i % 50} a b\nc {'d ' * (i % 5)}", "s" if i % 3 else None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_documents(docs, block=4, shard_slots=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    shares = mix_shares(docs, block=4, shard_slots=8).agg(F.sum("taken")).first()[0]
    assert sum(len(r.text.split()) for r in out.collect()) == shares
