"""Stateful streams: running statistics across restarts and from the changelog, the delay queue with timers."""

import time
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyflow.functions.headers import encode_headers
from tallyflow.operators import changelog, stats
from tallyflow.streaming import stateful
from tallyflow.streaming.jobs import gate

FIGURES = ("count", "mean", "m2", "min", "max")


def _records(spark, n=900):
    i = F.col("id")
    rows = spark.range(n).select(F.when(i % 11 == 0, None).otherwise((i % 7).cast("string")).alias("k"), F.when(i % 13 != 0, (i * 37 % 101).cast("double")).alias("v"), F.timestamp_millis(1_700_000_000_000 + i * 7919 % 10_000).alias("t"))
    return rows.select("*", F.coalesce(F.col("k").cast("int") % 3, F.lit(0)).alias("partition"), F.col("v").isNull().alias("x"), F.monotonically_increasing_id().alias("offset"))


def _run(stream, to, checkpoint, **more):
    def write(batch, number):
        batch.write.mode("append").parquet(to)

    query = stateful.running_states(stream, "k", "v", "t", **more).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()


def _figures(rows):
    return {r["key"]: tuple(round(r[c], 7) if r[c] is not None else None for c in FIGURES) + (r["last_updated"], r["last_offset"]) for r in rows}


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    df = _records(spark).persist()
    for part in range(3):
        df.where(f"floor(offset % 9 / 3) = {part}").coalesce(2).write.parquet(str(folder / f"part{part}"))
    return folder, df


def _stream(spark, folder, df, *numbers, to):
    import shutil

    Path(to).mkdir(exist_ok=True)
    for n in numbers:
        for f in (folder / f"part{n}").glob("*.parquet"):
            shutil.copy(f, Path(to) / f"{n}-{f.name}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(to)


def _wanted(df):
    rows = stats.fold(df.withColumnRenamed("k", "key"), "key", "v", "t").join(stats.last_offsets(df.withColumnRenamed("k", "key"), "key", ["offset"]).withColumnRenamed("key", "key2"), F.col("key").eqNullSafe(F.col("key2")))
    return _figures(rows.withColumn("last_updated", F.unix_millis("last_updated")).collect())


def test_three_restarts_equal_the_fold(spark, parts, tmp_path):
    folder, df = parts
    for n in range(3):
        _run(_stream(spark, folder, df, n, to=str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c"))
    state = stateful.read_states(spark, str(tmp_path / "c")).collect()
    assert _figures(state) == _wanted(df)
    rows = spark.read.parquet(str(tmp_path / "out"))
    last = rows.groupBy("key").agg(F.max_by(F.struct(*FIGURES, "last_updated", "last_offset"), "count").alias("r")).select("key", "r.*").collect()
    assert _figures(last) == _wanted(df)


def test_start_from_the_changelog(spark, parts, tmp_path):
    folder, df = parts
    _run(_stream(spark, folder, df.where("k is not null"), 0, 1, to=str(tmp_path / "a")).where("k is not null"), str(tmp_path / "out"), str(tmp_path / "c1"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    entries = changelog.encode(stateful.state_entries(rows), "partition")
    counts = F.get_json_object(F.col("value").cast("string"), "$.state.count").cast("long")  # a key's later rows hold larger ones
    log = entries.withColumns({"topic": F.lit("s"), "offset": F.row_number().over(Window.partitionBy("partition").orderBy(counts, "key")).cast("long"), "timestamp": F.timestamp_millis(F.lit(0))})
    restored = changelog.restore(log)
    state = _figures(stateful.read_states(spark, str(tmp_path / "c1")).collect())
    assert _figures(restored.withColumnRenamed("product", "key").withColumn("last_updated", F.unix_millis("last_updated")).collect()) == state
    _run(_stream(spark, folder, df, 2, to=str(tmp_path / "b")).where("k is not null"), str(tmp_path / "out2"), str(tmp_path / "c2"), initial=restored)
    assert _figures(stateful.read_states(spark, str(tmp_path / "c2")).collect()) == _wanted(df.where("k is not null"))


def test_merge_of_states():
    a, b = (2, 15.0, 50.0, 10.0, 20.0, 5000, 1, 7), (3, 40.0, 200.0, 30.0, 50.0, 4000, 1, 3)
    assert stateful.merged(a, b) == stateful.merged(b, a) == (5, 30.0, 1000.0, 10.0, 50.0, 5000, 1, 7)
    none = (0, 0.0, 0.0, None, None, 6000, 1, 9)
    assert stateful.merged(a, none) == (*a[:5], 6000, 1, 9) and stateful.merged(None, none) == none
    assert stateful.merged(none, b) == (*b[:5], 6000, 1, 9)


def _waiting(spark, low, high, base):
    i = F.col("id")
    rows = spark.range(low, high).select(F.when(i % 2 == 0, "orders.retry.5s").otherwise("orders.retry.30s").alias("topic"), (i % 3).cast("int").alias("partition"), i.alias("offset"), F.timestamp_millis(i).alias("timestamp"), F.lit(b"k").alias("key"), i.cast("string").cast("binary").alias("value"))
    o = F.col("offset")
    wait = F.when(o >= 150, base + 60_000).when(o % 10 == 5, base + o * 20)
    return stateful.waiting_records(rows.withColumn("headers", encode_headers({"x-retry-not-before": wait, "x": o})))


def _sent(spark, table):
    return sorted((r.retry_topic, r.partition, r.offset, r.forwarded_at) for r in spark.read.schema(stateful.FORWARDED).parquet(table).collect())


def test_timers_release_without_input_and_after_a_restart(spark, tmp_path):
    table, checkpoint, source = (str(tmp_path / x) for x in ("t", "c", "in"))
    base = int(time.time() * 1000) + 25_000
    all_rows = _waiting(spark, 0, 160, base).persist()

    def start():
        return stateful.delay_stream(spark.readStream.schema(all_rows.schema).parquet(source), table, checkpoint)

    def until(n, query, seconds=60):
        end = time.time() + seconds
        while time.time() < end and query.exception() is None:
            if Path(table, "_spark_metadata").exists() and len(_sent(spark, table)) >= n:
                break
            time.sleep(0.3)
        assert query.exception() is None
        return _sent(spark, table)

    all_rows.where("offset < 80").coalesce(1).write.mode("append").parquet(source)
    query = start()
    early = until(1, query)
    assert early and max(x[3] for x in early) < base  # what stands before each head
    query.stop()
    all_rows.where("offset >= 80").coalesce(1).write.mode("append").parquet(source)
    query = start()  # a restart: state and timers come from the checkpoint
    due = {(r.retry_topic, r.partition, r.offset) for r in gate(all_rows, base + 50_000)[0].collect()}
    assert len(due) == 150
    sent = until(len(due), query)
    time.sleep(1.5)
    held = {(r.topic, r.partition): r.records for r in stateful.held_records(spark, checkpoint).collect()}
    query.stop()
    assert [x[:3] for x in sent] == sorted(due)  # each once, none that is not due
    assert sum(held.values()) == 10
    times = {(r.topic, r.partition, r.offset): r.not_before or 0 for r in all_rows.collect()}
    assert all(at >= times[(t, p, o)] for t, p, o, at in sent)
    for t, p in held:
        own = [(o, at) for x, q, o, at in sent if (x, q) == (t, p)]
        assert [at for _, at in own] == sorted(at for _, at in own)  # in order
    last = max(int(x.name) for x in Path(checkpoint, "commits").iterdir() if x.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        Path(checkpoint, "commits", name).unlink(missing_ok=True)  # the batch counts as cut off: it is repeated
    query = start()
    time.sleep(6)
    assert query.exception() is None
    query.stop()
    assert _sent(spark, table) == sent


class _Held(dict):
    """A state of one key that counts its calls, as value or as map."""

    calls = 0

    def exists(self):
        return () in self

    def get(self):
        return self[()]

    def update(self, value):
        self.updateValue((), value)

    def getValue(self, key):  # noqa: N802
        _Held.calls += 1
        return self[key]

    def updateValue(self, key, value):  # noqa: N802
        _Held.calls += 1
        self[key] = value

    def removeKey(self, key):  # noqa: N802
        _Held.calls += 1
        del self[key]


class _Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, _):  # noqa: N802
        return self.states.setdefault(name, _Held())

    def getMapState(self, name, *_):  # noqa: N802
        return self.states.setdefault(name, _Held())

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.discard(at)


class _Now:
    def __init__(self, now):
        self.getCurrentProcessingTimeInMs = lambda: now


@pytest.mark.parametrize("held", [0, 1 << 25])
def test_a_delay_queue_calls_its_state_for_chunks_and_keeps_the_order(monkeypatch, held):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(stateful, "SPAN", 100)
    monkeypatch.setattr(stateful, "HELD_BYTES", held)  # 0: each chunk is stored before the order of the batch is known
    rng = np.random.default_rng(5)
    n, _Held.calls = 4_000, 0
    wait = np.where(rng.random(n) < 0.02, rng.integers(0, 50, n) + np.arange(n) // 100, 0)
    due = np.maximum.accumulate(wait)  # when a record and all before it are due
    header = pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))
    sent, handle = [], _Handle()

    def take(rows):
        for batch in stateful._records([pa.RecordBatch.from_pylist([r.asDict() for r in rows], pa.schema([("retry_topic", pa.string()), ("partition", pa.int32()), ("packed", pa.binary()), ("forwarded_at", pa.int64())]))]):
            sent.extend(zip(*(batch[c].to_pylist() for c in ("offset", "forwarded_at", "value", "headers", "retry_topic", "partition")), strict=True))

    for now in range(101):
        queue = stateful.DelayQueue()
        queue.init(handle)
        if now in (0, 7, 9, 30):  # a thousand records each, in any order
            o = rng.permutation(1_000) + 1_000 * (0, 7, 9, 30).index(now)
            fixed = [pa.array(["t"] * 1_000), pa.array([2] * 1_000, pa.int32()), pa.array(o), pa.array(o)]
            rows = pa.RecordBatch.from_arrays([*fixed, pa.array([b"k"] * 1_000), pa.array([b"%d" % x for x in o]), pa.array([[("h", b"%d" % x)] for x in o], header), pa.array([int(x) or None for x in wait[o]], pa.int64())], ["topic", "partition", "offset", "timestamp", "key", "value", "headers", "not_before"])
            chunks = [c for b in stateful._chunks([rows.slice(0, 300), rows.slice(300)]) for c in b.to_pylist()]
            assert len(chunks) == 10
            take(queue.handleInputRows(("t", 2), iter(chunks[::-1]), _Now(now)))
        if any(t <= now for t in handle.timers):
            handle.timers = {t for t in handle.timers if t > now}
            take(queue.handleExpiredTimer(("t", 2), _Now(now), None))
        head, tail, timer, _, records = handle.states["ends"].get()
        assert records == sum(x <= now for x in (0, 7, 9, 30)) * 1_000 - len(sent)
        assert (handle.timers == {timer}) if records else not handle.timers
    came = np.repeat([0, 7, 9, 30], 1_000)
    assert [x[:2] for x in sent] == [(i, int(max(due[i], came[i]))) for i in range(n)]
    assert all(v == b"%d" % i and h == [{"key": "h", "value": v}] and (t, p) == ("t", 2) for i, _, v, h, t, p in sent)
    assert not handle.states["queue"] and not handle.states["chunks"]
    assert _Held.calls < int((due > came).sum())  # not one for each record that waits
