"""Streams against their batch answers, and logs written and read again."""

import os

import pytest
from pyspark.sql import functions as F

from tallyflow.functions.headers import encode_headers, producer_headers, read_header
from tallyflow.operators import changelog, dlq, observe, routing, stats
from tallyflow.sources.log import read_dead_letters, read_log, read_log_stream, tier_table, topic_names, with_offsets, write_log
from tallyflow.sources.segments import append_log, log_stream, scan_log
from tallyflow.sources.synth import MARKER, inject_faults, synth_orders
from tallyflow.streaming import jobs


def _log(spark, n, topic="orders"):
    rows = spark.range(n).select(F.lit(topic).alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.floor(F.col("id") / 3).cast("long").alias("offset"), F.timestamp_millis(F.col("id") * 1000).alias("timestamp"), F.concat(F.lit("k"), F.col("id") % 5).cast("binary").alias("key"), F.col("id").cast("string").cast("binary").alias("value"))
    return rows.withColumn("headers", encode_headers({"x": F.col("offset")}))


def test_logs(spark, tmp_path):
    path = str(tmp_path / "log")
    names = topic_names("o")
    assert names == {"main": "o", "5s": "o.retry.5s", "30s": "o.retry.30s", "5m": "o.retry.5m", "dlq": "o.dlq", "state": "o.aggregate.state"}
    for topic in ("orders", "orders.dlq"):
        write_log(_log(spark, 30, topic), path)
    assert read_log(spark, path).count() == 60 and read_log(spark, path, ["orders"]).count() == 30 and read_log(spark, path, ["none"]).count() == 0
    letters = [(r.partition, r.offset) for r in read_dead_letters(spark, path).collect()]
    assert letters == sorted(letters) and len(letters) == 30
    q = read_log_stream(spark, path, ["orders", "orders.dlq"]).writeStream.format("memory").queryName("both").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert spark.table("both").count() == 60
    with pytest.raises(ValueError, match="log_stream"):
        read_log_stream(spark, path, starting="latest")
    assert len({read for (read,) in spark.range(20).select(read_header(producer_headers("1"), "x-correlation-id")).collect()}) == 20


def test_offsets_in_spans(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("p"), (F.col("id") * 37 % 500).alias("t"))
    got = sorted((r.p, r.t, r.offset) for r in with_offsets(df, "p", ["t"], F.floor(F.col("t") / 40)).collect())
    want = [(p, t, i) for p in range(3) for i, t in enumerate(sorted(t for q, t, _ in got if q == p))]
    assert got == want


def test_synthetic_orders(spark):
    orders = synth_orders(spark, 3000)
    rows = orders.collect()
    assert [int(r.order_id) for r in rows] == list(range(1001, 4001)) and all(1 <= r.price <= 500 and abs(r.price * 100 - round(r.price * 100)) < 1e-2 for r in rows)
    faults = inject_faults(orders, 0.2, 0.1)
    n = {r.fault: r["count"] for r in faults.groupBy("fault").count().collect()}
    assert abs(n["poison"] - 300) < 60 and abs(n["transient"] - 600) < 90
    assert faults.where("fault = 'transient'").select("sent_product").distinct().collect()[0][0] == MARKER
    turns = [r.flavour for r in faults.where("fault = 'poison'").orderBy(F.col("order_id").cast("int")).collect()]
    assert turns[:4] == ["json", "unknown-schema", "truncated", "json"]


def test_outcomes_go_to_their_sinks(spark, tmp_path):
    df = _log(spark, 200)
    df.write.parquet(str(tmp_path / "in"))

    def handler(batch):
        number = F.col("value").cast("string").cast("long")
        return batch.withColumn("attempt", (number % 5).cast("int")).withColumn("error_kind", F.when(number % 3 == 0, "transient").when(number % 7 == 0, "permanent"))

    source = {"topic": F.col("topic"), "partition": F.col("partition"), "offset": F.col("offset"), "timestamp": F.unix_millis("timestamp"), "key": F.col("key").cast("string")}
    error = {"type": F.col("error_type"), "class": F.lit("Error"), "reason": F.lit(None).cast("string"), "message": F.lit("m"), "stack": F.lit("s")}
    dead = lambda rows: dlq.letter_records(rows, dlq.dead_letter_headers(F.col("headers"), source, error, F.col("attempt"), F.lit("now"), "g", "1"))
    sinks = {"processed": lambda rows: rows.select("key", "value"), "retried": lambda rows: rows, "dead-lettered": dead}
    jobs.outcome_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), handler, tier_table(spark), sinks, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    batch = {r.outcome: r["count"] for r in routing.route(handler(df), tier_table(spark)).groupBy("outcome").count().collect()}
    got = {x: spark.read.parquet(str(tmp_path / "out" / x)).count() for x in sinks}
    assert got == batch and sum(got.values()) == 200
    letters = spark.read.parquet(str(tmp_path / "out" / "dead-lettered"))
    assert {r.topic for r in letters.collect()} == {"orders.dlq"} and letters.select(F.size("headers")).distinct().collect()[0][0] == 15
    records, results = dlq.replay(dlq.select_letters(letters, everything=True), F.lit("now"))
    assert records.count() == results.count() == got["dead-lettered"]


def test_a_batch_cut_off_between_its_sinks_leaves_one_outcome_each(spark, tmp_path):
    source, out, c, flag = (str(tmp_path / x) for x in ("in", "out", "c", "flag"))
    append_log(_log(spark, 200), source, partitions=3)

    def handler(batch):
        number = F.col("value").cast("string").cast("long")
        return batch.withColumn("attempt", (number % 5).cast("int")).withColumn("error_kind", F.when(number % 3 == 0, "transient").when(number % 7 == 0, "permanent"))

    def dies(v):
        if v == b"189" and not os.path.exists(flag):
            raise RuntimeError("killed")
        return v

    to = lambda topic: lambda rows: rows.withColumn("topic", F.lit(topic)).withColumn("value", F.udf(dies, "binary")("value"))
    sinks = {"processed": to("state"), "retried": to("retry"), "dead-lettered": to("dlq")}

    def run():
        jobs.outcome_log_stream(log_stream(spark, source), handler, tier_table(spark), sinks, out, c, "router").awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    assert scan_log(spark, out).count() == 0
    open(flag, "w").close()
    run()
    for name in ("0", ".0.crc"):
        os.unlink(os.path.join(c, "commits", name))  # and cut off once more, after its outcomes were written
    run()
    append_log(_log(spark, 20), source, partitions=3)
    run()
    rows = scan_log(spark, out).groupBy("topic").agg(F.count("*").alias("n"), F.count_distinct("value").alias("d")).collect()
    batch = {r.outcome: r["count"] for r in routing.route(handler(_log(spark, 200).union(_log(spark, 20))), tier_table(spark)).groupBy("outcome").count().collect()}
    assert {r.topic: r.n for r in rows} == {"state": batch["processed"], "retry": batch["retried"], "dlq": batch["dead-lettered"]} and sum(r.d for r in rows) == 200


def test_snapshots_and_batches(spark, tmp_path):
    df = spark.range(600).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").cast("double").alias("v"), F.timestamp_millis("id").alias("t"))
    heard = jobs.BatchLog()
    spark.streams.addListener(heard)
    for part in (0, 1):
        df.where(f"floor(v / 300) = {part}").write.mode("append").parquet(str(tmp_path / "in"))
        jobs.snapshot_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "k", "v", "t", str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    rows = {r.key: (r["count"], round(r["mean"], 9), round(r["m2"], 3)) for r in jobs.newest_batch(spark.read.parquet(str(tmp_path / "out"))).collect()}
    want = {r.key: (r["count"], round(r["mean"], 9), round(r["m2"], 3)) for r in stats.snapshot(df, "k", "v", "t").collect()}
    assert rows == want and rows[None][0] == 600
    odd = spark.createDataFrame([("b", 1.0), ("A", 2.0), (None, 3.0), ("a", 4.0), ("B", 5.0), ("__T", 6.0)], "k string, v double").withColumn("t", F.lit(1))
    shown = stats.snapshot(odd, "k", "v", "t", [2, 0, 11, 2]).collect()
    assert [(r.key, r.overall, r["count"], r.partitions) for r in shown] == [(None, False, 1, None), ("__T", False, 1, None), ("a", False, 1, None), ("A", False, 1, None), ("b", False, 1, None), ("B", False, 1, None), (None, True, 6, [0, 2, 11])]
    ends = spark.createDataFrame([(p, 10) for p in (11, 2, 0)], "partition int, end long")
    assert [r.partition for r in observe.lag(ends, ends.withColumnRenamed("end", "committed"), [2]).collect()] == [0, 2, 11]
    assert [r.key for r in stats.snapshot(df.where("false"), "k", "v", "t").collect()] == [None]
    for _ in range(50):
        if sum(r[2] for r in heard.rows) >= 600:
            break
        __import__("time").sleep(0.1)
    spark.streams.removeListener(heard)
    counts = observe.batch_counts(heard.table(spark)).first()
    assert counts.handled == counts.committed == 600 and counts.failed == 0


def test_changelog_control_data(spark):
    state = spark.createDataFrame([("Item1", 2, 9007199254740993, 2, 12.62, 108.6338, 5.25, 19.99, 1700000001000)], "product string, partition int, last_offset long, count long, mean double, m2 double, min double, max double, at long")
    good = changelog.encode(state.withColumn("last_updated", F.timestamp_millis("at"))).first()
    bad = [None, b"garbage", bytes([0, 1, 2]), good.value.replace(b'"v":1', b'"v":2'), good.value.replace(b'"count":2', b'"count":0'), good.value.replace(b'"m2":', b'"m2":-')]
    log = spark.createDataFrame([("s", 0, i, bytearray(b"Item1"), None if v is None else bytearray(v)) for i, v in enumerate([bytes(good.value), *bad])], "topic string, partition int, offset long, key binary, value binary").withColumn("timestamp", F.timestamp_millis("offset"))
    r = changelog.restore(log).collect()
    assert len(r) == 1 and r[0].last_offset == 9007199254740993 and r[0]["count"] == 2 and r[0].partition == 2
    assert changelog.restore(log, [0]).count() == 0
    s = changelog.skipped(log).first()
    assert (s.empty, s.bad) == (1, 5)


def test_later_offsets_win_whatever_the_time(spark):
    rows = [("s", 0, o, t, bytearray(k), None if v is None else bytearray(v)) for o, t, k, v in [(10, 2000, b"a", b"old"), (11, 1000, b"a", b"new"), (12, 500, b"b", b"x"), (13, 400, b"b", None)]]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, at long, key binary, value binary").withColumn("timestamp", F.timestamp_millis("at")).drop("at")
    assert sorted((bytes(r.key), r.offset) for r in changelog.compact(log).collect()) == [(b"a", 11), (b"b", 13)]
    state = spark.createDataFrame([("a", 0, o, o, 1.0, 0.0, 1.0, 1.0, 5) for o in (10, 11)], "product string, partition int, last_offset long, count long, mean double, m2 double, min double, max double, at long").withColumn("last_updated", F.timestamp_millis("at"))
    values = {r.last_offset: r.value for r in changelog.encode(state, "last_offset").collect()}
    log = spark.createDataFrame([("s", 0, 10, 2000, bytearray(b"a"), values[10]), ("s", 0, 11, 1000, bytearray(b"a"), values[11])], "topic string, partition int, offset long, at long, key binary, value binary").withColumn("timestamp", F.timestamp_millis("at"))
    assert [r.last_offset for r in changelog.restore(log).collect()] == [11]
