"""One query for each operator, over the driver's tables, with the same result in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyflow.functions import frame, headers
from tallyflow.operators import changelog, dlq, observe, republish, routing, stats
from tallyflow.sources.log import tier_table, with_offsets
from tallyflow.sources.synth import inject_faults


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _log(spark: SparkSession, d: str) -> DataFrame:
    """events as a log: partition by user, offset in the partition."""
    e = _t(spark, d, "events").withColumn("partition", (F.col("user_id") % 3).cast("int"))
    e = with_offsets(e, "partition", ["ts", "event_id"], F.date_trunc("hour", "ts"))
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(F.lit("orders").alias("topic"), "partition", "offset", "ts", "event_id", "event_type", "value", k.alias("k"))


_LOG = "(SELECT 'orders' AS topic, CAST(user_id % 3 AS INT) AS partition, row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) - 1 AS \"offset\", ts, event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) AS log"
#: Digits after the point: of figures over few values, which are fractions with few of them, and over many.
FEW = {"mean": 6, "m2": 6, "variance": 6, "stddev": 6}
MANY = {"mean": 7, "m2": 2, "variance": 5, "stddev": 5}


def _rounded(df: DataFrame, digits: dict[str, int], *keys: str) -> DataFrame:
    names = [c for c in ("count", "mean", "m2", "min", "max", "variance", "stddev", "last_updated") if c in df.columns]
    return df.select(*keys, *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in names])


def _sql(value: str, at: str, digits: dict[str, int], spread: bool = True) -> str:
    v, d = f"CAST({value} AS DOUBLE)", digits
    more = f", round(var_samp({v}), {d['variance']}) AS variance, round(stddev_samp({v}), {d['stddev']}) AS stddev" if spread else ""
    return f"count({v}) AS count, round(coalesce(avg({v}), 0), {d['mean']}) AS mean, round(coalesce(var_pop({v}) * count({v}), 0), {d['m2']}) AS m2, min({v}) AS min, max({v}) AS max{more}, max({at}) AS last_updated"


def running_stats_by_key(spark, d):
    return _rounded(stats.fold(_t(spark, d, "lineitem"), "l_partkey", "l_quantity", "l_shipdate"), FEW, "l_partkey")


def global_stats(spark, d):
    return _rounded(stats.overall(_t(spark, d, "events"), "value", "ts"), MANY)


def snapshot(spark, d):
    return _rounded(stats.snapshot(_t(spark, d, "events"), "event_type", "value", "ts"), MANY, "key")


def stats_merge_from_partials(spark, d):
    parts = stats.fold(_t(spark, d, "events").withColumn("part", F.struct("event_type", "user_id")), "part", "value", "ts")
    return _rounded(stats.merge_states(parts.withColumn("event_type", F.col("part.event_type")), "event_type"), MANY, "event_type")


def running_state_history(spark, d):
    rows = stats.history(_log(spark, d), "event_type", "value", "ts", ["ts", "event_id"], F.date_trunc("day", "ts"))
    return rows.select("event_id", "event_type", "count", F.round(F.col("mean") + 1e-9, 4).alias("mean"), F.round("variance", 2).alias("variance"), "min", "max", "last_updated")


def latest_state_per_key(spark, d):
    return changelog.latest(_log(spark, d), "k", ["ts", "partition", "offset"], [0, 2]).select("k", "partition", "offset", "event_id", "value")


def restore_partitions(spark, d):
    log = _log(spark, d)
    now = changelog.latest(log, "event_id", ["ts"]).select("event_id", "partition", "value")
    old = log.where("k < 50").select("event_id", "partition", (F.col("value") + 1).alias("value"))
    return changelog.restore_partitions(now, old, [0, 1]).select("event_id", "partition", F.round("value", 4).alias("value"))


def validation_report(spark, d):
    x = _t(spark, d, "lineitem")
    rows = x.select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 7 == 0, "").otherwise(F.col("l_orderkey").cast("string")).alias("o"), F.when(F.col("l_partkey") % 5 == 0, "").otherwise("p").alias("p"), F.when(F.col("l_suppkey") % 3 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("price"))
    return rows.withColumn("message", routing.violations(F.col("o"), F.col("p"), F.col("price"))).groupBy("message").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


def classify_errors(spark, d):
    k = F.col("k")
    null = lambda t: F.lit(None).cast(t)
    code = F.when(k % 10 == 0, "ECONNRESET")
    status = F.when(k % 4 == 1, 400 + k)
    text = F.when(k % 6 == 0, F.concat(F.lit("Request timed out after "), k.cast("string"))).otherwise(F.lit("broken"))
    e = routing.classify(null("string"), null("string"), code, status, F.when(k % 4 == 2, F.lit(503)), k % 9 == 0, text)
    return _log(spark, d).select("event_id", e.alias("e")).select("event_id", "e.kind", "e.reason", "e.message")


def _routed(spark, d):
    rows = _log(spark, d).withColumn("attempt", (F.col("k") % 5).cast("int")).withColumn("error_kind", F.when(F.col("k") % 3 == 0, "transient").when(F.col("k") % 11 == 0, "permanent"))
    return routing.route(rows, tier_table(spark))


def outcome_router(spark, d):
    return _routed(spark, d).select("event_id", "outcome", "delivery", "tier", "delay_ms", "error_type")


def outcome_tally(spark, d):
    return routing.tally(_routed(spark, d))


def due_records(spark, d):
    rows = _log(spark, d).withColumn("not_before", F.when(F.col("k") >= 99, F.col("offset") + 900))
    return routing.due(rows, 1000, ["topic", "partition"]).where("due").select("event_id", "partition", "offset")


def _letters(spark, d):
    return _routed(spark, d).where("outcome = 'dead-lettered'")


def dlq_list(spark, d):
    origin = F.concat("topic", F.lit("["), F.col("partition").cast("string"), F.lit("]@"), F.col("offset").cast("string"))
    return _letters(spark, d).select("event_id", origin.alias("origin"), F.col("event_type").alias("key"), "error_type").orderBy("event_id")


def dlq_select_range(spark, d):
    return dlq.select_letters(_letters(spark, d), low=100, high=500).select("event_id", "partition", "offset")


def dlq_newest(spark, d):
    return dlq.newest(_letters(spark, d), 20, ["partition", "offset"]).select("event_id", "partition", "offset")


def dlq_by_type(spark, d):
    return dlq.by_type(_letters(spark, d))


def latency_histogram(spark, d):
    rows = _t(spark, d, "events").select("event_type", (F.col("value") / 10).alias("seconds"))
    return observe.histogram(rows, "event_type", "seconds", observe.END_TO_END).select("event_type", "le", "n", "total", F.round("sum", 2).alias("sum"))


def throughput(spark, d):
    return observe.throughput(_t(spark, d, "events"), "event_type", "ts", 86_400).select("event_id", "per_second")


def throughput_10s(spark, d):
    return observe.throughput(_t(spark, d, "events"), "event_type", "ts").select("event_id", "per_second")


def topic_depth(spark, d):
    return observe.depth(_log(spark, d))


def partition_lag(spark, d):
    log = _log(spark, d)
    ends = log.groupBy("partition").agg((F.max("offset") + 1).alias("end"))
    return observe.lag(ends, log.where("partition < 2 and k < 50").groupBy("partition").agg((F.max("offset") + 1).alias("committed")), [0, 2])


def truncate_utf8(spark, d):
    return _t(spark, d, "documents").select("doc_id", dlq.truncate_utf8(F.col("text"), 1024).alias("text")).select("doc_id", F.octet_length("text").alias("bytes"), F.md5(F.col("text").cast("binary")).alias("digest"))


def frame_decode(spark, d):
    """lineitem as framed orders with faults, decoded: all figures of the valid ones are as before."""
    x = _t(spark, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("order_id"), F.concat(F.lit("Item"), F.col("l_suppkey").cast("string")).alias("product"), F.col("l_extendedprice").cast("float").alias("price"))
    value = frame.encode_order(F.lit(7), F.col("order_id"), F.col("product"), F.col("price"))
    rows = frame.decode_orders(x.select(value.alias("value")))
    return rows.groupBy("schema_id", "product").agg(F.count("*").alias("n"), F.count("error").alias("errors"), F.round(F.sum(F.col("price").cast("double")), 0).alias("price"), F.sum(F.col("order_id").cast("long")).alias("ids"))


def fault_mix(spark, d):
    """Orders of the lineitem table with faults injected by a hash of their id: rows of each fault and flavour."""
    x = _t(spark, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("order_id"), F.lit("Item1").alias("product"), F.col("l_extendedprice").cast("float").alias("price"))
    return inject_faults(x, roll=F.col("order_id").cast("long") % 100 / 100.0).groupBy("fault", "flavour").agg(F.count("*").alias("n"), F.sum((frame.frame_error(F.col("value")).isNotNull()).cast("long")).alias("no_frame"))


def replay_headers(spark, d):
    one = headers.encode_headers({"x-correlation-id": F.col("event_id"), "x-error-type": F.lit("permanent"), dlq.REPLAY_COUNT: F.when(F.col("k") > 50, F.col("k"))})
    new = dlq.replay_headers(one, F.col("offset"), F.lit("2024-01-01T00:00:00.000Z"))
    return _log(spark, d).select("event_id", new.alias("h")).select("event_id", F.array_join(headers.header_names(F.col("h")), ",").alias("names"), headers.read_int_header(F.col("h"), dlq.REPLAY_COUNT).alias("replays"), headers.read_header(F.col("h"), "x-correlation-id").alias("correlation_id"))


def dead_letter_headers(spark, d):
    rows, k = _letters(spark, d), F.col("k")
    first = F.when(k % 2 == 0, "2024-01-01T00:00:00.000Z")
    old = headers.encode_headers({headers.ORIGINAL_PARTITION: F.when(k % 2 == 0, 9), headers.FIRST_FAILED_AT: first, headers.CORRELATION_ID: F.when(k % 4 == 0, k)})
    error = {"type": F.col("error_type"), "class": F.lit("Error"), "reason": F.when(F.col("error_type") == "permanent", "validation"), "message": F.lit("bad"), "stack": F.lit("    at déjà vu\n" * 400)}
    source = {"topic": F.col("topic"), "partition": F.col("partition"), "offset": F.col("offset"), "timestamp": F.unix_millis(F.col("ts").cast("timestamp")), "key": F.col("event_type")}
    h = dlq.dead_letter_headers(old, source, error, F.col("attempt"), F.lit("2025-01-01T00:00:00.000Z"), "group", "1.0")
    read = lambda name: headers.read_header(F.col("h"), name)
    texts = {"origin": "x-original-partition", "at": "x-original-offset", "key": "x-original-key", "error_type": "x-error-type", "message": "x-error-message", "attempt": "x-attempt-count", "first_failed_at": "x-first-failed-at", "last_failed_at": "x-last-failed-at", "correlation_id": "x-correlation-id"}
    short = F.octet_length(read("x-error-stack")).between(2030, 2048).alias("stack_cut")
    return rows.select("event_id", h.alias("h")).select("event_id", F.size("h").cast("long").alias("n"), short, *[read(name).alias(c) for c, name in texts.items()])


def retry_republish(spark, d):
    k = F.col("k")
    old = headers.encode_headers({"x-correlation-id": F.col("event_id"), headers.ORIGINAL_PARTITION: F.when(k % 2 == 0, 9), headers.FIRST_FAILED_AT: F.when(k % 2 == 0, "2024-01-01T00:00:00.000Z")})
    rows = _routed(spark, d).withColumn("headers", old).withColumn("timestamp_ms", F.lit(5))
    out = republish.escalate(rows, F.lit(1_000).cast("long"), F.lit("2025-01-01T00:00:00.000Z"))
    number = lambda name: headers.read_int_header(F.col("headers"), name)
    return out.select("event_id", "topic", F.size("headers").cast("long").alias("n"), number(headers.RETRY_ATTEMPT).alias("attempt"), number(headers.RETRY_NOT_BEFORE).alias("not_before"), number(headers.ORIGINAL_PARTITION).alias("origin"), headers.read_header(F.col("headers"), headers.FIRST_FAILED_AT).alias("first_failed_at"))


def forward_due(spark, d):
    queue = _log(spark, d).withColumn("not_before", F.when(F.col("k") >= 99, F.col("offset") + 900)).withColumn("topic", F.lit("orders.retry.5s"))
    out = republish.forward_due(queue, queue.where("k < 30"), 1000)
    return out.select("event_id", "topic", "retry_topic", "partition", "offset")


def retry_plan(spark, d):
    draw = F.col("k") % 4 * F.lit(0.25).cast("double")
    plan = republish.retry_plan(F.col("k") % 5, F.array(draw, draw), budget_ms=120)
    return _log(spark, d).select("event_id", plan.alias("p")).select("event_id", "p.attempts", "p.elapsed_ms", "p.succeeded")


def decode_report(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("value"), headers.encode_headers({"b": F.col("source"), "a": F.lit(1)}).alias("headers"))
    return republish.decode_report(rows).select("doc_id", "frame_error", "hex", F.array_join("header_names", ",").alias("names"), F.col("price").isNull().alias("undecoded"))


def conform_schema(spark, d):
    return routing.conform(_t(spark, d, "customer"), {"c_custkey": "bigint", "c_name": "string", "region": "string"}, {"region": "none"})


_ROUTED = f"""(SELECT *, CASE WHEN k % 3 = 0 AND k % 5 < 3 THEN 'retried' WHEN k % 3 = 0 OR k % 11 = 0 THEN 'dead-lettered' ELSE 'processed' END AS outcome,
 CASE WHEN k % 3 = 0 AND k % 5 >= 3 THEN 'transient-exhausted' WHEN k % 3 <> 0 AND k % 11 = 0 THEN 'permanent' END AS error_type FROM {_LOG}) AS routed"""
_BOUNDS = ", ".join(f"('{float(b)}', {float(b)}::DOUBLE)" for b in observe.END_TO_END)

ORACLE = {
    "dead_letter_headers": f"""SELECT event_id, CAST(15 AS BIGINT) AS n, true AS stack_cut, CASE WHEN k % 2 = 0 THEN '9' ELSE CAST(partition AS VARCHAR) END AS origin, CAST("offset" AS VARCHAR) AS at, event_type AS key, error_type,
 CASE WHEN error_type = 'permanent' THEN 'validation: bad' ELSE 'bad' END AS message, CAST(k % 5 AS VARCHAR) AS attempt, CASE WHEN k % 2 = 0 THEN '2024-01-01T00:00:00.000Z' ELSE '2025-01-01T00:00:00.000Z' END AS first_failed_at,
 '2025-01-01T00:00:00.000Z' AS last_failed_at, CASE WHEN k % 4 = 0 THEN CAST(k AS VARCHAR) ELSE '' END AS correlation_id FROM {_ROUTED} WHERE outcome = 'dead-lettered'""",
    "running_stats_by_key": f"SELECT l_partkey, {_sql('l_quantity', 'l_shipdate', FEW)} FROM lineitem GROUP BY l_partkey",
    "global_stats": f"SELECT {_sql('value', 'ts', MANY)} FROM events",
    "snapshot": f"SELECT event_type AS key, {_sql('value', 'ts', MANY)} FROM events GROUP BY GROUPING SETS ((event_type), ())",
    "stats_merge_from_partials": f"SELECT event_type, {_sql('value', 'ts', MANY, False)} FROM events GROUP BY event_type",
    "running_state_history": "SELECT event_id, event_type, count(value) OVER w AS count, round(avg(value) OVER w + 1e-9, 4) AS mean, round(var_samp(value) OVER w, 2) AS variance, min(value) OVER w AS min, max(value) OVER w AS max, max(ts) OVER w AS last_updated FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)",
    "latest_state_per_key": f"SELECT k, partition, \"offset\", event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC, partition DESC, \"offset\" DESC) AS r FROM {_LOG} WHERE partition IN (0, 2)) WHERE r = 1",
    "restore_partitions": f"SELECT event_id, partition, round(value, 4) AS value FROM {_LOG} WHERE partition NOT IN (0, 1) UNION ALL SELECT event_id, partition, round(value + 1, 4) FROM {_LOG} WHERE k < 50 AND partition IN (0, 1)",
    "validation_report": "SELECT concat_ws('; ', CASE WHEN l_orderkey % 7 = 0 THEN 'orderId: orderId must not be empty' END, CASE WHEN l_partkey % 5 = 0 THEN 'product: product must not be empty' END, CASE WHEN l_suppkey % 3 = 0 AND l_extendedprice > 0 THEN 'price: price must not be negative' END) AS message, count(*) AS n, sum(l_orderkey) AS keys FROM lineitem GROUP BY 1",
    "classify_errors": f"SELECT event_id, CASE WHEN k % 10 = 0 OR (k % 4 = 1 AND 400 + k IN (408, 425, 429)) OR (k % 4 = 2) THEN 'transient' WHEN k % 4 = 1 AND 400 + k < 500 THEN 'permanent' WHEN k % 9 = 0 OR k % 6 = 0 THEN 'transient' ELSE 'permanent' END AS kind, CASE WHEN kind = 'permanent' THEN 'unclassified' END AS reason, CASE WHEN k % 10 = 0 THEN 'ECONNRESET: ' WHEN k % 4 = 1 AND 400 + k < 500 THEN concat('HTTP ', 400 + k, ': ') WHEN k % 4 = 2 THEN 'HTTP 503: ' WHEN k % 9 = 0 THEN 'retriable client error: ' WHEN k % 6 = 0 THEN 'timeout: ' ELSE '' END || CASE WHEN k % 6 = 0 THEN concat('Request timed out after ', k) ELSE 'broken' END AS message FROM {_LOG}",
    "outcome_router": f"SELECT event_id, outcome, CAST(k % 5 + 1 AS INT) AS delivery, CASE WHEN outcome = 'retried' THEN CASE k % 5 WHEN 0 THEN '5s' WHEN 1 THEN '30s' ELSE '5m' END END AS tier, CASE WHEN outcome = 'retried' THEN CASE k % 5 WHEN 0 THEN 5000 WHEN 1 THEN 30000 ELSE 300000 END END AS delay_ms, error_type FROM {_ROUTED}",
    "outcome_tally": f"SELECT o.outcome, count(r.event_id) AS n FROM (VALUES ('processed'), ('retried'), ('dead-lettered'), ('forwarded')) AS o(outcome) LEFT JOIN {_ROUTED.replace('AS routed', 'AS r')} ON o.outcome = r.outcome GROUP BY 1",
    "due_records": f"SELECT event_id, partition, \"offset\" FROM (SELECT *, max(CASE WHEN k >= 99 THEN \"offset\" + 900 ELSE 0 END) OVER (PARTITION BY topic, partition ORDER BY \"offset\" ROWS UNBOUNDED PRECEDING) AS m FROM {_LOG}) WHERE m <= 1000",
    "dlq_list": f"SELECT event_id, concat(topic, '[', partition, ']@', \"offset\") AS origin, event_type AS key, error_type FROM {_ROUTED} WHERE outcome = 'dead-lettered'",
    "dlq_select_range": f"SELECT event_id, partition, \"offset\" FROM {_ROUTED} WHERE outcome = 'dead-lettered' AND \"offset\" BETWEEN 100 AND 500",
    "dlq_newest": f"SELECT event_id, partition, \"offset\" FROM {_ROUTED} WHERE outcome = 'dead-lettered' ORDER BY partition DESC, \"offset\" DESC LIMIT 20",
    "dlq_by_type": f"SELECT error_type, count(*) AS n FROM {_ROUTED} WHERE outcome = 'dead-lettered' GROUP BY 1",
    "latency_histogram": f"SELECT event_type, le, count(*) FILTER (value / 10 <= b) AS n, count(*) AS total, round(sum(value / 10), 2) AS sum FROM events, (VALUES {_BOUNDS}, ('+Inf', 'infinity'::DOUBLE)) AS bounds(le, b) GROUP BY event_type, le",
    "throughput": "SELECT event_id, round(count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 86400 SECONDS PRECEDING AND CURRENT ROW) / 86400.0, 2) AS per_second FROM events",
    "throughput_10s": "SELECT event_id, round(count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 10 SECONDS PRECEDING AND CURRENT ROW) / 10.0, 2) AS per_second FROM events",
    "topic_depth": f"SELECT topic, CAST(count(*) AS BIGINT) AS depth FROM {_LOG} GROUP BY topic",
    "partition_lag": f"SELECT a.partition, a.\"end\", b.committed, CASE WHEN b.committed IS NOT NULL THEN greatest(0, a.\"end\" - b.committed) END AS lag, a.partition IN (0, 2) AS owned FROM (SELECT partition, max(\"offset\") + 1 AS \"end\" FROM {_LOG} GROUP BY 1) a LEFT JOIN (SELECT partition, max(\"offset\") + 1 AS committed FROM {_LOG} WHERE partition < 2 AND k < 50 GROUP BY 1) b ON a.partition = b.partition",
    "frame_decode": "SELECT CAST(7 AS INT) AS schema_id, concat('Item', l_suppkey) AS product, count(*) AS n, CAST(0 AS BIGINT) AS errors, round(sum(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE)), 0) AS price, sum(l_orderkey * 8 + l_linenumber) AS ids FROM lineitem GROUP BY l_suppkey",
    "replay_headers": f"SELECT event_id, 'x-correlation-id,x-replay-count,x-replayed-at,x-replayed-from-dlq-offset' AS names, CAST(CASE WHEN k > 50 THEN k + 1 ELSE 1 END AS BIGINT) AS replays, CAST(event_id AS VARCHAR) AS correlation_id FROM {_LOG}",
    "retry_republish": f"""SELECT event_id, concat('orders.retry.', CASE k % 5 WHEN 0 THEN '5s' WHEN 1 THEN '30s' ELSE '5m' END) AS topic, CAST(9 AS BIGINT) AS n, CAST(k % 5 + 1 AS BIGINT) AS attempt, CAST(1000 + CASE k % 5 WHEN 0 THEN 5000 WHEN 1 THEN 30000 ELSE 300000 END AS BIGINT) AS not_before,
 CAST(CASE WHEN k % 2 = 0 THEN 9 ELSE partition END AS BIGINT) AS origin, CASE WHEN k % 2 = 0 THEN '2024-01-01T00:00:00.000Z' ELSE '2025-01-01T00:00:00.000Z' END AS first_failed_at FROM {_ROUTED} WHERE outcome = 'retried'""",
    "forward_due": f"SELECT event_id, 'orders' AS topic, 'orders.retry.5s' AS retry_topic, partition, \"offset\" FROM (SELECT *, max(CASE WHEN k >= 99 THEN \"offset\" + 900 ELSE 0 END) OVER (PARTITION BY partition ORDER BY \"offset\" ROWS UNBOUNDED PRECEDING) AS m FROM {_LOG} WHERE k >= 30) WHERE m <= 1000",
    "retry_plan": f"SELECT event_id, CAST(CASE WHEN k % 5 = 0 THEN 1 WHEN k % 5 = 1 OR k % 4 >= 2 THEN 2 ELSE 3 END AS INT) AS attempts, CAST(CASE attempts WHEN 1 THEN 0 WHEN 2 THEN k % 4 * 25 ELSE k % 4 * 75 END AS BIGINT) AS elapsed_ms, attempts > k % 5 AS succeeded FROM {_LOG}",
    "decode_report": "SELECT doc_id, CASE WHEN text IS NULL THEN 'payload is null' WHEN strlen(text) < 5 THEN concat('payload is ', strlen(text), ' bytes; Confluent framing requires at least 5') ELSE concat('expected magic byte 0x00, found 0x', lower(hex(encode(text))[1:2])) END AS frame_error, lower(hex(encode(text))[1:128]) AS hex, CASE WHEN source IS NULL THEN 'a' ELSE 'a,b' END AS names, true AS undecoded FROM documents",
    "truncate_utf8": f"SELECT doc_id, strlen(s) AS bytes, md5(s) AS digest FROM (SELECT doc_id, CASE WHEN strlen(text) > 1024 THEN concat(coalesce({', '.join(f'try(decode(encode(text)[1:{n}]))' for n in (1010, 1009, 1008, 1007))}), '{dlq.CUT}') ELSE text END AS s FROM documents)",
    "fault_mix": """SELECT fault, CASE WHEN fault = 'poison' THEN ['json', 'unknown-schema', 'truncated'][(turn - 1) % 3 + 1] END AS flavour, count(*) AS n, CAST(count(*) FILTER (fault = 'poison' AND (turn - 1) % 3 = 0) AS BIGINT) AS no_frame FROM
 (SELECT fault, row_number() OVER (PARTITION BY fault ORDER BY id) AS turn FROM (SELECT l_orderkey * 8 + l_linenumber AS id, CASE WHEN id % 100 < 5 THEN 'poison' WHEN id % 100 < 20 THEN 'transient' ELSE 'valid' END AS fault FROM lineitem)) GROUP BY 1, 2""",
    "conform_schema": "SELECT c_custkey, c_name, 'none' AS region FROM customer",
}


def queries() -> dict:
    every = (running_stats_by_key, global_stats, snapshot, stats_merge_from_partials, running_state_history, latest_state_per_key, restore_partitions, validation_report, classify_errors, outcome_router, outcome_tally, due_records, dlq_list, dlq_select_range, dlq_newest, dlq_by_type, latency_histogram, throughput, throughput_10s, topic_depth, partition_lag, truncate_utf8, frame_decode, fault_mix, replay_headers, dead_letter_headers, retry_republish, forward_due, retry_plan, decode_report, conform_schema)
    return {f.__name__: f for f in every}
