"""Control data of frames, validation, classes and merges."""

import math

from pyspark.sql import functions as F

from tallyflow.functions.frame import decode_orders, encode_order
from tallyflow.operators.dlq import truncate_utf8
from tallyflow.operators.routing import violations
from tallyflow.operators.stats import fold, merge_states, overall


def test_frames(spark):
    rows = [("1001", "Item1", 19.99), ("x" * 200, "é", -5.0), ("a", "b", 0.0), ("a", "b", 1e-40), ("a", "b", math.inf)]
    df = spark.createDataFrame(rows, "o string, p string, x double").select("o", "p", F.col("x").cast("float").alias("x"))
    got = decode_orders(df.select("*", encode_order(F.lit(7), F.col("o"), F.col("p"), F.col("x")).alias("value"))).collect()
    assert all(r.error is None and r.schema_id == 7 and (r.order_id, r.product, r.price) == (r.o, r.p, r.x) for r in got)


def test_bad_frames(spark):
    bad = [bytearray(b'{"orderId":"9999"}'), bytearray(bytes.fromhex("133742990102")), bytearray(b""), None, bytearray(bytes.fromhex("00000F423F024100")), bytearray(bytes.fromhex("0000000001083130"))]
    got = decode_orders(spark.createDataFrame([(x,) for x in bad], "value binary")).collect()
    assert all(r.error for r in got)
    assert got[0].error == "expected magic byte 0x00, found 0x7b" and got[4].schema_id == 999999


def test_validation(spark):
    df = spark.createDataFrame([("1", "a", 0.0), ("", "", -0.01), ("1", "a", float("nan")), ("1", "a", -math.inf)], "o string, p string, x double")
    got = [r[0] for r in df.select(violations(F.col("o"), F.col("p"), F.col("x"))).collect()]
    assert got[0] == "" and got[1].count(";") == 2 and got[2] == "price: price must be a finite number" and got[3].count(";") == 1


def test_statistics(spark):
    df = spark.createDataFrame([("a", 10.0, 1), ("a", 20.0, 2), ("b", 30.0, 3), ("b", 40.0, 5), ("b", 50.0, 4)], "k string, v double, t int")
    r = overall(df, "v", "t").first()
    assert (r["count"], r["mean"], r["m2"], r["variance"], r["last_updated"]) == (5, 30.0, 1000.0, 250.0, 5)
    m = merge_states(fold(df, "k", "v", "t")).first()
    assert (m["count"], m["mean"], m["min"], m["max"]) == (5, 30.0, 10.0, 50.0) and abs(m["m2"] - 1000) < 1e-9
    e = overall(df.where("false"), "v", "t").first()
    assert (e["count"], e["mean"], e["min"], e["variance"]) == (0, 0.0, None, None)
    near = spark.createDataFrame([(1e9 + x,) for x in (4, 7, 13, 16)], "v double").withColumn("t", F.lit(1))
    assert abs(overall(near, "v", "t").first()["variance"] - 30) < 1e-6


def test_truncation(spark):
    text = "    at déjà vu (file.js:1:1)\n" * 400
    out = spark.createDataFrame([(text,)], "s string").select(truncate_utf8(F.col("s"), 2048)).first()[0]
    assert len(out.encode()) <= 2048 and out.endswith("…[truncated]") and "�" not in out


def test_stream_equals_batch(spark, tmp_path):
    from tallyflow.streaming.jobs import latest_stats, stats_stream

    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").cast("double").alias("v"), F.col("id").alias("t"))
    for part in (0, 1):
        df.where(f"t % 2 = {part}").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        q = stats_stream(stream, "k", "v", "t", str(tmp_path / f"out{part}"), str(tmp_path / "check"))
        q.awaitTermination()
    got = {r.k: (r["count"], round(r["mean"], 9)) for r in latest_stats(spark.read.parquet(str(tmp_path / "out1")), "k").collect()}
    assert got == {r.k: (r["count"], round(r["mean"], 9)) for r in fold(df, "k", "v", "t").collect()}


def test_retry_plan_stops_at_the_budget(spark):
    from tallyflow.operators.republish import retry_plan

    plan = retry_plan(F.lit(1000), F.array_repeat(F.lit(0.999), 100), attempts=100, budget_ms=120)
    r = spark.range(1).select(plan.alias("p")).first().p
    assert (r.attempts, r.elapsed_ms, r.succeeded) == (2, 99, False)


def test_router_stream_equals_batch(spark, tmp_path):
    from tallyflow.operators.routing import route
    from tallyflow.sources.log import tier_table
    from tallyflow.streaming.jobs import router_stream

    def handler(df):
        return df.withColumn("attempt", (F.col("id") % 5).cast("int")).withColumn("error_kind", F.when(F.col("id") % 3 == 0, "transient").when(F.col("id") % 7 == 0, "permanent"))

    df = spark.range(500)
    for part in (0, 1):
        df.where(f"id % 2 = {part}").write.mode("append").parquet(str(tmp_path / "in"))
        router_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), handler, tier_table(spark), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = sorted((r.id, r.outcome, r.tier) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((r.id, r.outcome, r.tier) for r in route(handler(df), tier_table(spark)).collect())
