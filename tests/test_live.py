"""Handlers, windows, distinct orders and figures of running streams."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyflow.operators import observe, routing
from tallyflow.operators.handler import HandlerError, classified, handle, permanent, transient
from tallyflow.sources.log import tier_table
from tallyflow.sources.segments import append_log, log_stream
from tallyflow.streaming import metrics
from tallyflow.streaming.windows import distinct_stream, throughput_windows


def test_one_bad_record_has_its_own_outcome(spark):
    def handler(batch, attempt):
        for n, delivery in zip(batch["n"], batch["delivery"], strict=True):
            if n == 7:
                raise ValueError("broken")
            if n == 8:
                raise permanent("no such product", "validation")
            if n == 9 and delivery < 2:
                raise transient("outage")
            if n == 10 and attempt < 3:
                raise TimeoutError("request timed out")

    df = spark.range(40).select(F.col("id").alias("n"), F.lit(1).alias("delivery")).repartition(2)
    got = {r.n: (r.error_kind, r.error_reason, r.error_message, r.tries) for r in handle(df, handler, base_ms=1).collect()}
    assert got.pop(7) == ("permanent", "unclassified", "broken", 1) and got.pop(8) == ("permanent", "validation", "no such product", 1)
    assert got.pop(9) == ("transient", None, "outage", 3) and got.pop(10) == (None, None, None, 3)
    assert len(got) == 36 and {v[:3] for v in got.values()} == {(None, None, None)}
    routed = routing.route(handle(df, handler, base_ms=1).withColumn("attempt", F.lit(0)), tier_table(spark))
    assert {r.outcome: r["count"] for r in routed.groupBy("outcome").count().collect()} == {"processed": 37, "dead-lettered": 2, "retried": 1}


def test_errors_by_record_and_the_budget(spark):
    calls = spark.sparkContext.accumulator(0)

    def handler(batch, attempt):
        calls.add(len(batch))
        return [transient("x") if n % 2 else None for n in batch["n"]]

    df = spark.range(10).select(F.col("id").alias("n")).coalesce(1)
    rows = handle(df, handler, attempts=5, budget_ms=150, base_ms=100, draw=lambda: 0.99, sleep=lambda s: None).collect()
    assert {(r.n % 2, r.tries) for r in rows} == {(0, 1), (1, 1 + 1)} or {(r.n % 2, r.tries) for r in rows} == {(0, 1), (1, 1)}
    rows = handle(df, handler, attempts=3, base_ms=0).collect()
    assert {(r.n % 2, r.tries) for r in rows} == {(0, 1), (1, 3)}
    assert handle(df.where("false"), handler).count() == 0


def test_classes():
    def error(text, **more):
        e = Exception(text)
        e.__dict__.update(more)
        return classified(e)

    assert error("x", code="ECONNRESET") == ("transient", None, "ECONNRESET: x") and error("x", status=503) == ("transient", None, "HTTP 503: x")
    assert error("x", status_code=404) == ("permanent", "unclassified", "HTTP 404: x") and error("x", retriable=True)[0] == "transient"
    assert error("Timeout waiting for coordinator")[2].startswith("timeout: ") and error("x") == ("permanent", "unclassified", "x")
    assert classified(HandlerError("permanent", "m", "validation")) == ("permanent", "validation", "m")


def _run(df, to, checkpoint, mode="append"):
    query = df.writeStream.format("parquet").option("path", to).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_windows_close_and_equal_the_table(spark, tmp_path):
    df = spark.range(600).select((F.col("id") % 3).cast("string").alias("k"), F.timestamp_millis(F.col("id") * 250 + F.when(F.col("id") % 50 == 23, -4000).otherwise(0)).alias("t"))
    states = []
    for part in range(6):
        df.where(f"unix_millis(t) >= {part * 25_000} and unix_millis(t) < {(part + 1) * 25_000}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = _run(throughput_windows(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "k", "t"), str(tmp_path / "out"), str(tmp_path / "c"))
        states.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress))
    key = lambda r: (r.k, r.window_start, r.window_end, r.n, r.per_second)
    got = sorted(key(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    table = throughput_windows(df, "k", "t")
    closed = sorted(key(r) for r in table.where(F.unix_millis("window_end") <= 150_000 - 250 - 10_000).collect())
    assert got == closed and len(got) > 300
    assert max(states) < 60 * 3 and max(states[2:]) <= states[1] + 12  # bounded: what has closed has gone
    per_record = observe.throughput(df, "k", "t").where("unix_millis(t) % 1000 = 750").select("k", (F.unix_millis("t") + 250).alias("e"), "per_second").distinct()
    assert per_record.join(table.select("k", F.unix_millis("window_end").alias("e"), F.col("per_second").alias("w")), ["k", "e"]).where("abs(per_second - w) > 0.11").count() == 0


def test_duplicates_go_across_restarts(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 100).cast("string").alias("o"), F.timestamp_millis(F.col("id") * 100 + 1000).alias("t"), F.col("id").alias("i"))
    for part in range(3):
        df.where(f"floor(i / 100) = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        _run(distinct_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "o", "t", "1 hour"), str(tmp_path / "out"), str(tmp_path / "c"))
    from tallyflow.operators.stats import distinct_orders

    assert sorted(r.i for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(r.i for r in distinct_orders(df, "o", ["t"]).collect())


def test_figures_come_from_the_batches(spark, tmp_path):
    log = str(tmp_path / "log")
    i = F.col("id")
    records = spark.range(200).select(F.lit("orders").alias("topic"), i.cast("string").cast("binary").alias("key"), i.cast("string").cast("binary").alias("value"), F.timestamp_millis(i * 1000).alias("timestamp"))
    append_log(records, log, partitions=3)
    listener = metrics.MetricsLog(str(tmp_path / "m"))
    spark.streams.addListener(listener)

    def run(fails=False):
        n = F.col("value").cast("string").cast("long")
        rows = log_stream(spark, log).withColumn("attempt", (n % 5).cast("int")).withColumn("error_kind", F.when(n % 3 == 0, "transient").when(n % 7 == 0, "permanent"))
        rows = metrics.observed(routing.route(rows, tier_table(spark)), F.lit(200_000), F.unix_millis("timestamp"))
        if fails:
            rows = rows.withColumn("outcome", F.udf(lambda x: 1 / 0, "string")("outcome"))
        rows.writeStream.queryName("router").format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

    run()
    append_log(records.limit(40), log, partitions=3)
    with pytest.raises(Exception, match="ZeroDivision"):
        run(fails=True)
    run()
    for _ in range(100):
        if len(list(Path(tmp_path / "m").iterdir())) >= 3:
            break
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    table = metrics.batches(spark, str(tmp_path / "m"))
    assert tuple(metrics.totals(table).first()) == (240, 240, 1)
    n = [*range(200), *range(40)]
    retried = [x for x in n if x % 3 == 0 and x % 5 < 3]
    assert {r.outcome: r.n for r in metrics.counters(table, "outcome", "outcome").collect()} == {"processed": sum(x % 3 > 0 and x % 7 > 0 for x in n), "retried": len(retried), "dead-lettered": sum((x % 3 == 0 and x % 5 > 2) or (x % 3 > 0 and x % 7 == 0) for x in n), "forwarded": 0}
    assert {r.tier: r.n for r in metrics.counters(table, "tier", "tier").collect()} == {t: sum(x % 5 == k for x in retried) for k, t in enumerate(("5s", "30s", "5m"))}
    hist = {r.le: (r.n, r.total, r["sum"]) for r in metrics.end_to_end(table).collect()}
    assert hist["+Inf"] == (240, 240, sum(200 - x for x in n)) and hist["60.0"][0] == sum(200 - x <= 60 for x in n)
    took = {(r.metric, r.le): r.n for r in metrics.durations(table).collect()}
    assert took[("order_processing_duration_seconds", "+Inf")] == took[("offset_commit_duration_seconds", "+Inf")] == table.where("committed").count()
    assert {r.lag for r in metrics.newest_lag(table).collect()} == {0}
    assert metrics.source_lag('{"ends": {"a/0": 5}}', '{"ends": {"a/0": 9, "a/1": 2}}', {}) == {"a/0": 4, "a/1": 2} and metrics.source_lag(None, None, {"maxOffsetsBehindLatest": "3"}) == {"all": 3}


def test_throughput_reads_no_window_twice(spark):
    """A crowd within one window, times at the borders of spans, and records without a time or key."""
    crowd = spark.range(300_000).select(F.lit("a").alias("k"), F.timestamp_micros(F.col("id")).alias("t"))
    started = time.monotonic()
    assert observe.throughput(crowd, "k", "t").agg(F.sum("per_second")).first()[0] == sum(round(n / 10, 2) for n in range(1, 300_001)).__round__(2)
    assert time.monotonic() - started < 60  # with a frame for each row: 45 thousand million additions
    span, second = 600_000_000, 1_000_000
    times = [0, span - 1, span, span + 10 * second, 2 * span - 1, 2 * span - 1, 3 * span - 1, None, None]
    for seconds in (10, 600):
        rows = [(k, t) for k in ("a", None) for t in times]
        df = spark.createDataFrame(rows, "k string, m long").withColumn("t", F.timestamp_micros("m"))
        got = sorted(((r.k, r.m, r.per_second) for r in observe.throughput(df, "k", "t", seconds).collect()), key=str)
        n = [sum(u is t if t is None or u is None else t - seconds * second <= u <= t for u in times) for t in times]
        assert got == sorted(((k, t, round(x / seconds, 2)) for k in ("a", None) for t, x in zip(times, n, strict=True)), key=str)


def test_a_bad_record_does_not_cost_a_call_for_each(spark):
    calls = spark.sparkContext.accumulator(0)

    def handler(batch, attempt):
        calls.add(1)
        if batch["n"].isin([13, 700]).any():
            raise ValueError("bad")

    got = handle(spark.range(1000).select(F.col("id").alias("n")).coalesce(1), handler).collect()
    assert {r.n for r in got if r.error_message == "bad" and r.tries == 1} == {13, 700} and sum(r.error_kind is not None for r in got) == 2
    assert [r.n for r in got] == list(range(1000)) and calls.value < 50  # by themselves: 1001
