"""The log as a data source: offsets, bounded scans, restarts, commits that are whole or not there."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tallyflow.sources import segments
from tallyflow.sources.segments import append_log, ends, log_sink, log_stream, scan_log, sweep


def _records(spark, low, high, topic="orders"):
    i = F.col("id")
    return spark.range(low, high).select(F.lit(topic).alias("topic"), F.concat(F.lit("k"), i % 7).cast("binary").alias("key"), i.cast("string").cast("binary").alias("value"), F.timestamp_millis(i).alias("timestamp"), F.array(F.struct(F.lit("x").alias("key"), i.cast("string").cast("binary").alias("value"))).alias("headers"))


def _values(rows):
    return sorted(int(r.value) for r in rows)


def _drain(stream, name, checkpoint):
    out = []
    stream.writeStream.foreachBatch(lambda df, n: out.extend(df.collect())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return out


def test_offsets_are_gapless_and_keys_keep_their_partition(spark, tmp_path):
    path = str(tmp_path / "log")
    for low in (0, 50, 100):
        append_log(_records(spark, low, low + 50), path, partitions=4)
    append_log(_records(spark, 0, 10, "orders.dlq"), path, partitions=4)
    rows = scan_log(spark, path, ["orders"]).collect()
    assert _values(rows) == list(range(150)) and all(r.headers[0].value == r.value and r.timestamp.timestamp() * 1000 == pytest.approx(int(r.value)) for r in rows)
    by: dict = {}
    for r in rows:
        by.setdefault(r.partition, []).append(r)
    for p, own in by.items():
        assert sorted(r.offset for r in own) == list(range(len(own))) and ends(path)[f"orders/{p}"] == len(own)
        for key in {r.key for r in own}:  # later writes have later offsets
            values = [int(r.value) // 50 for r in sorted(own, key=lambda r: r.offset) if r.key == key]
            assert values == sorted(values)
    assert len({(bytes(r.key), r.partition) for r in rows}) == 7
    assert scan_log(spark, path).count() == 160 and scan_log(spark, path, ["none"]).count() == 0
    assert scan_log(spark, str(tmp_path / "empty")).count() == 0
    part = max(by, key=lambda p: len(by[p]))
    some = scan_log(spark, path, ["orders"], starting=f'{{"orders/{part}": 5}}', ending=f'{{"orders/{part}": 9}}').where(f"partition = {part}")
    assert sorted(r.offset for r in some.collect()) == [5, 6, 7, 8]


def test_a_scan_ends_where_the_log_ended(spark, tmp_path):
    path = str(tmp_path / "log")
    append_log(_records(spark, 0, 40), path)
    scan = scan_log(spark, path, ending="latest")
    fixed = scan_log(spark, path, ending=__import__("json").dumps(ends(path)))
    scan.explain()  # planned
    rows = scan.rdd  # partitions are those of the plan
    assert rows.getNumPartitions() > 0
    append_log(_records(spark, 40, 80), path)
    assert rows.count() == 40 and fixed.count() == 40 and scan_log(spark, path).count() == 80
    with pytest.raises(Exception, match="timed out after"):
        scan_log(spark, path, timeout_ms=-1).collect()


def test_latest_loses_nothing_across_restarts(spark, tmp_path):
    path, c = str(tmp_path / "log"), str(tmp_path / "c")
    append_log(_records(spark, 0, 30), path)
    assert _drain(log_stream(spark, path, starting="latest"), "a", c) == []  # nothing new yet
    append_log(_records(spark, 30, 40), path)  # while the query is down
    append_log(_records(spark, 900, 910, "other"), path)
    got = _values(_drain(log_stream(spark, path, ["orders"], starting="latest"), "b", c))
    append_log(_records(spark, 40, 45), path)
    got += _values(_drain(log_stream(spark, path, ["orders"], starting="latest"), "c", c))
    assert got == list(range(30, 45))
    first = min(r.partition for r in scan_log(spark, path, ["orders"]).collect())
    told = _drain(log_stream(spark, path, ["orders"], starting=f'{{"orders/{first}": 2}}'), "d", str(tmp_path / "e"))
    assert len(told) == 43 and min(r.offset for r in told if r.partition == first) == 2
    assert _values(_drain(log_stream(spark, path, ["orders"]), "f", str(tmp_path / "g"))) == list(range(45))


def test_batches_are_committed_once_and_whole(spark, tmp_path):
    source, path, c, flag = (str(tmp_path / x) for x in ("in", "log", "c", "flag"))
    append_log(_records(spark, 0, 60), source)

    def broken(v):
        if int(v) == 33 and not os.path.exists(flag):
            raise RuntimeError("killed")
        return v

    def run():
        stream = log_stream(spark, source).withColumn("value", F.udf(broken, "binary")("value"))
        log_sink(stream, path, "copy", c).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    assert scan_log(spark, path).count() == 0  # nothing of a batch that failed
    open(flag, "w").close()
    run()
    assert _values(scan_log(spark, path).collect()) == list(range(60))
    for name in ("0", ".0.crc"):
        os.unlink(os.path.join(c, "commits", name))  # cut off after the write, before the position was stored
    run()
    assert _values(scan_log(spark, path).collect()) == list(range(60))
    append_log(_records(spark, 60, 70), path, writer="job", batch=3)
    append_log(_records(spark, 60, 70), path, writer="job", batch=3)
    assert scan_log(spark, path).count() == 70
    with open(os.path.join(path, "data", "orphan.parquet"), "w"):
        pass
    assert sweep(path) == 0 and sweep(path, -1) == 1 and scan_log(spark, path).count() == 70


def test_two_writers_take_two_numbers(tmp_path):
    store = segments.Store(str(tmp_path))
    file = {"file": "f", "topic": "t", "partition": 0, "rows": 5}
    real, raced = store.last, []

    def last():
        number = real()
        if not raced:
            raced.append(1)
            segments.Store(str(tmp_path)).add([file], "other", 0)
        return number

    store.last = last
    assert store.add([file], "own", 0) == 1
    assert [s["offset"] for n in (0, 1) for s in store.commit(n)["segments"]] == [0, 5] and store.commit(1)["writers"] == {"other": 0, "own": 0}
    assert time.time() > 0 and sorted(os.listdir(tmp_path / "commits")) == ["000000000000.json", "000000000001.json"]
