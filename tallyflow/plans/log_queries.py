"""Queries of the log jobs: decoding, dead letters, replay, changelog, retry gate and metrics, with the same results in SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import avro, frame, headers, text
from tallyflow.operators import changelog, decode, dlq, observe, republish, routing, stats
from tallyflow.plans.queries import _LOG, _ROUTED, MANY, _letters, _log, _routed, _rounded, _sql, _t
from tallyflow.sources.log import tier_table, with_offsets
from tallyflow.sources.synth import POISON_JSON, truncated_payload, unknown_schema_payload
from tallyflow.streaming.jobs import gate

NOW = "2025-01-01T00:00:00.000Z"


def decode_job(spark, d):
    """lineitem as framed orders, one in eight with a fault of each kind, decoded and checked."""
    x = _t(spark, d, "lineitem").select(((F.col("l_orderkey") * 8 + F.col("l_linenumber")) % 16).alias("fault"), F.col("l_orderkey").cast("string").alias("order_id"), F.concat(F.lit("Item"), F.col("l_suppkey").cast("string")).alias("product"), F.col("l_extendedprice").cast("float").alias("price"))
    f = F.col("fault")
    good = frame.encode_order(F.when(f == 8, 8).otherwise(7), F.when(f == 6, "").otherwise(F.col("order_id")), F.when(f == 7, "").otherwise(F.col("product")), F.when(f == 7, -F.col("price")).otherwise(F.col("price")))
    value = F.when(f == 0, F.lit(None).cast("binary")).when(f == 1, F.lit(POISON_JSON).cast("binary")).when(f == 2, F.lit("abc").cast("binary")).when(f == 3, unknown_schema_payload()).when(f == 4, truncated_payload(good)).when(f == 5, F.concat(good, F.unhex(F.lit("00")))).otherwise(good)
    schemas = spark.sql("SELECT * FROM VALUES (7, 'orders-value', 1), (9, 'orders-value', 2) AS t(schema_id, subject, version)")
    rows = decode.decode_job(x.select(value.alias("value")), schemas)
    return rows.groupBy("schema_id", "error_reason", "error_message").agg(F.count("*").alias("n"), F.count("order_id").alias("orders"), F.round(F.sum(F.col("price").cast("double")), 0).alias("price"))


def _schema(*fields) -> str:
    return json.dumps({"type": "record", "name": "Order", "fields": [{"name": n, "type": t, **more} for n, t, more in fields]})


#: Schemas that orders are written with (two good versions, a retyped price, a lost product), by id, and the reader's.
_ID, _PRODUCT = ("orderId", "string", {}), ("product", "string", {})
_WRITERS = {
    1: _schema(_ID, _PRODUCT, ("price", "float", {})),
    2: _schema(("customer", "long", {}), _ID, ("price", "int", {}), ("currency", "string", {}), _PRODUCT, ("note", ["null", "string"], {})),
    3: _schema(_ID, _PRODUCT, ("price", "string", {})),
    4: _schema(_ID, ("price", "float", {})),
}
_READER = _schema(_ID, _PRODUCT, ("price", "double", {}), ("currency", "string", {"default": "EUR"}), ("note", ["null", "string"], {"default": None}))


def decode_versions(spark, d):
    """lineitem as orders of four writers' schemas in one log, read as one: added fields have defaults, lost ones are passed over, numbers are promoted, what cannot be read is told."""
    key, n = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    product, price = F.concat(F.lit("Item"), F.col("l_suppkey").cast("string")), F.col("l_extendedprice")
    note = F.when(n % 2 == 0, F.col("l_linestatus"))
    forms = {
        1: F.struct(key.alias("orderId"), product.alias("product"), price.cast("float").alias("price")),
        2: F.struct(F.col("l_partkey").alias("customer"), key.alias("orderId"), F.floor(price).cast("int").alias("price"), F.lit("LKR").alias("currency"), product.alias("product"), note.alias("note")),
        3: F.struct(key.alias("orderId"), product.alias("product"), price.cast("string").alias("price")),
        4: F.struct(key.alias("orderId"), price.cast("float").alias("price")),
    }
    x = _t(spark, d, "lineitem").withColumn("schema_id", (F.when(n == 7, 4).when(n == 6, 3).otherwise(F.col("l_orderkey") % 2 + 1)).cast("int"))
    logs = [x.where(F.col("schema_id") == i).select("schema_id", frame.build_frame(F.lit(i), avro.encode_avro(form, _WRITERS[i])).alias("value")) for i, form in forms.items()]
    log = logs[0].union(logs[1]).union(logs[2]).union(logs[3])
    known = spark.createDataFrame(list(_WRITERS.items()), "id int, writer string")
    rows = log.select(frame.schema_id(F.col("value")).alias("id"), frame.payload(F.col("value")).alias("body")).join(decode.small(known), "id")
    rows = rows.select(F.col("id").alias("schema_id"), avro.decode_avro(F.col("body"), F.col("writer"), _READER).alias("x")).select("schema_id", "x.record.*", "x.error")
    return rows.groupBy("schema_id", "currency", "note", "error").agg(F.count("*").alias("n"), F.count("product").alias("products"), F.sum(F.col("orderId").cast("long")).alias("ids"), F.round(F.sum("price"), 0).alias("price"))


def schema_verdicts(spark, d):
    """Whether a reader of each proposed schema could read what each nation's orders were written with, and why not."""
    n = F.col("n_nationkey") % 4 + 1
    written = F.element_at(F.create_map(*[F.lit(x) for kv in _WRITERS.items() for x in kv]), n.cast("int"))
    return avro.compatibility(_t(spark, d, "nation").select("n_nationkey", written.alias("written"), F.lit(_READER).alias("proposed"))).select("n_nationkey", "accepted", "detail")


def valid_orders(spark, d):
    x = _t(spark, d, "lineitem")
    ok = routing.is_order(F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey").cast("string")), F.lit("p"), F.when(F.col("l_suppkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")))
    return x.groupBy("l_returnflag", ok.alias("valid")).agg(F.count("*").alias("n"))


def format_orders(spark, d):
    x = _t(spark, d, "lineitem").where("l_linenumber = 1")
    return x.select("l_orderkey", text.format_order(F.col("l_orderkey"), F.concat(F.lit("Item"), F.col("l_suppkey")), F.col("l_extendedprice")).alias("line"))


def marker_failures(spark, d):
    k = F.col("k")
    fails = routing.marker_fails(F.when(k % 4 == 0, routing.MARKER).otherwise(F.col("event_type")), k % 5 + 1, 4)
    return _log(spark, d).select("event_id", fails.alias("fails"))


def registry_errors(spark, d):
    status = F.element_at(F.array(*[F.lit(x) for x in (409, 422, 404, 401, 403, 500, 503)]), (F.col("k") % 7 + 1).cast("int"))
    e = routing.classify_registry(status)
    return _log(spark, d).select("event_id", status.alias("status"), e.alias("e")).select("event_id", "status", "e.kind", "e.reason")


def describe_errors(spark, d):
    k = F.col("k")
    message = F.when(k % 3 == 0, F.concat(F.lit("broken "), k.cast("string")))
    thrown = F.when(k % 3 == 1, F.struct(k.alias("code"), F.col("event_type").alias("at")))
    return _log(spark, d).select("event_id", text.describe_error(message, thrown).alias("message"))


def _letter_log(spark, d) -> DataFrame:
    """The dead letters of the routed log, as records of the dead-letter topic."""
    k = F.col("k")
    rows = _letters(spark, d).withColumns({"timestamp": F.col("ts").cast("timestamp"), "key": F.when(k % 5 != 0, F.col("event_type")).cast("binary"), "value": F.col("event_id").cast("string").cast("binary")})
    old = headers.encode_headers({headers.CORRELATION_ID: F.when(k % 4 == 0, F.concat(F.lit("correlation-"), k.cast("string"))), dlq.REPLAY_COUNT: F.when(k % 7 == 0, k), "x-other": k})
    error = {"type": F.col("error_type"), "class": F.when(k % 2 == 0, "Error"), "reason": F.when(F.col("error_type") == "permanent", "validation"), "message": F.lit("bad"), "stack": F.lit(None).cast("string")}
    source = {"topic": F.col("topic"), "partition": F.col("partition"), "offset": F.col("offset"), "timestamp": F.unix_millis("timestamp"), "key": F.col("key").cast("string")}
    return dlq.letter_records(rows, dlq.dead_letter_headers(old, source, error, F.col("attempt"), F.lit(NOW), "group", "1.0"))


def dlq_write(spark, d):
    return _letter_log(spark, d).select("topic", "partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), F.size("headers").cast("long").alias("n"), F.array_contains(headers.header_names(F.col("headers")), "x-other").alias("other"))


def dlq_metadata(spark, d):
    m = _letter_log(spark, d).select("partition", "offset", dlq.metadata(F.col("headers")).alias("m")).select("partition", "offset", "m.*")
    return m.withColumn("error_stack", F.length("error_stack").cast("long"))


def dlq_list_rows(spark, d):
    return dlq.shown_rows(dlq.list_rows(_letter_log(spark, d)))


def dlq_listing(spark, d):
    return dlq.listing(_letter_log(spark, d), 50)[1].select("error_type", "n", "shown", "total")


def dlq_select_offsets(spark, d):
    wanted = _log(spark, d).where("k = 12").select("offset").distinct()
    return dlq.select_letters(_letters(spark, d), offsets=wanted).select("event_id", "partition", "offset")


def dlq_replay(spark, d):
    letters = dlq.select_letters(_letter_log(spark, d), low=100)
    again = letters.withColumn("headers", headers.merge_headers(F.col("headers"), headers.encode_headers({dlq.REPLAY_COUNT: F.when(F.col("offset") % 2 == 0, F.col("offset"))})))
    records, results = dlq.replay(again, F.lit(NOW))
    sent = records.select("partition", F.col("offset").alias("dlq_offset"), F.col("value").cast("string").alias("value"), F.array_join(headers.header_names(F.col("headers")), ",").alias("names"))
    return results.groupBy("dlq_offset", "target").agg(F.count("*").alias("n"), F.sum("replay_count").alias("replays")).join(sent.groupBy("dlq_offset").agg(F.max("names").alias("names"), F.sum(F.col("value").cast("long")).alias("ids")), "dlq_offset")


def _states(spark, d) -> DataFrame:
    """A changelog made of the events: a state row for each, keyed by k, with partitions by key and times that go back again and again; some are bad, null or of another version."""
    k, v = F.col("k"), F.col("value")
    e = _t(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("partition", (k % 3).cast("int"))
    e = with_offsets(e, "partition", ["event_id"], F.floor(F.col("event_id") / 10_000))
    at = F.col("ts").cast("timestamp") - F.make_dt_interval(days=(F.col("event_id") % 50).cast("int"))
    log = e.withColumns({"product": F.concat(F.lit("p"), k.cast("string")), "last_offset": F.col("offset"), "timestamp": at})
    state = log.withColumns({"count": F.col("offset") + 1, "mean": v, "m2": v, "min": v, "max": v, "last_updated": F.col("ts").cast("timestamp")})
    at = F.struct("timestamp", "partition", "offset")
    rows = changelog.encode(state.select("product", "partition", "last_offset", "count", "mean", "m2", "min", "max", "last_updated", at.alias("at")), "at")
    good = F.col("value")
    changed = F.when(F.col("at.offset") % 10 == 0, F.lit(None).cast("binary")).when(F.col("at.offset") % 10 == 1, F.lit("garbage").cast("binary")).when(F.col("at.offset") % 10 == 2, F.replace(good.cast("string"), F.lit('"v":1'), F.lit('"v":2')).cast("binary")).otherwise(good)
    return rows.select(F.lit("orders.aggregate.state").alias("topic"), "at.partition", "at.offset", "at.timestamp", "key", changed.alias("value"))


def changelog_restore(spark, d):
    return changelog.restore(_states(spark, d), [0, 2]).select("product", "partition", "last_offset", "count", "mean", F.unix_millis("last_updated").alias("last_updated"))


def changelog_skipped(spark, d):
    return changelog.skipped(_states(spark, d))


def changelog_compact(spark, d):
    return changelog.compact(_states(spark, d)).select(F.col("key").cast("string").alias("key"), "partition", "offset", F.col("value").isNull().alias("empty"))


def dropped_entries(spark, d):
    return changelog.dropped_count(_log(spark, d), [0])


def last_offsets(spark, d):
    return stats.last_offsets(_log(spark, d), "k", ["ts", "partition", "offset"])


def product_count(spark, d):
    return stats.key_count(_t(spark, d, "lineitem"), "l_partkey")


def product_lookup(spark, d):
    return _rounded(stats.lookup(stats.snapshot(_t(spark, d, "events"), "event_type", "value", "ts"), "click"), MANY, "key")


def state_view(spark, d):
    states = stats.fold(_t(spark, d, "events").withColumn("value", F.when(F.col("user_id") % 5 != 0, F.col("value"))), "user_id", "value", "ts").drop("variance", "stddev")
    return stats.view(states).select("user_id", "count", F.round("mean", 6).alias("mean"), "min", "max", F.round("variance", 4).alias("variance"), F.round("stddev", 4).alias("stddev"), "last_updated")


def distinct_orders(spark, d):
    return stats.distinct_orders(_log(spark, d), "k", ["ts", "event_id"]).select("k", "event_id", "partition", "offset")


def total_lag(spark, d):
    log = _log(spark, d)
    ends = log.groupBy("partition").agg((F.max("offset") + 1).alias("end"))
    return observe.total_lag(observe.lag(ends, log.where("partition < 2 and k < 50").groupBy("partition").agg((F.max("offset") + 1).alias("committed"))))


def retried_by_tier(spark, d):
    return observe.counter(_routed(spark, d).where("outcome = 'retried'"), "tier", ["5s", "30s", "5m"])


def _waiting(spark, d) -> DataFrame:
    k = F.col("k")
    topic = F.when(k % 4 == 0, "orders.retry.5s").when(k % 4 == 1, "orders.retry.30s").when(k % 4 == 2, "orders.retry.5m").otherwise("orders.retry.old")
    return _log(spark, d).withColumns({"topic": topic, "not_before": F.when(k % 9 == 0, F.col("offset") + 800).cast("long")})


def forwarded_by_tier(spark, d):
    return observe.forwarded_by_tier(gate(_waiting(spark, d), 1000)[0], tier_table(spark))


def paused_partitions(spark, d):
    return observe.held_partitions(routing.due(_waiting(spark, d), 1000, ["topic", "partition"]), ["topic", "partition"])


def forward_outcomes(spark, d):
    return gate(_waiting(spark, d), 1000)[0].select("event_id", "topic", "retry_topic", "outcome")


def batch_counts(spark, d):
    runs = _t(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("handled")).withColumn("committed", F.col("user_id") % 10 != 0)
    return observe.batch_counts(runs)


def duration_histograms(spark, d):
    """Processing by outcome, commits and changelog writes by partition, in the buckets of short durations: three figures of each record in one scan. (``stream_queries.batch_metrics`` has the figures of real batches.)"""
    number = F.col("k").cast("double")
    figures = {"order_processing_duration_seconds": ("outcome", F.col("value")), "offset_commit_duration_seconds": ("topic", number), "changelog_write_duration_seconds": ("topic", number / 10)}
    each = F.array(*[F.struct(F.struct(F.lit(name).alias("metric"), F.col(label).alias("label")).alias("m"), (x / 100).alias("seconds")) for name, (label, x) in figures.items()])
    rows = _routed(spark, d).select(F.explode(each).alias("x")).select("x.*")
    return observe.histogram(rows, "m", "seconds", observe.FAST).select("m.metric", "m.label", "le", "n", "total", F.round("sum", 2).alias("sum"))


def times_and_ages(spark, d):
    ts, k = F.unix_millis(F.col("ts").cast("timestamp")), F.col("k")
    iso = text.to_iso(ts)
    seconds = text.end_to_end_seconds(ts + (k - 20) * 100, F.when(k % 2 == 0, ts - k * 60_000), ts)
    return _log(spark, d).select("event_id", iso.alias("iso"), text.short_iso(iso).alias("shown"), (text.from_iso(iso) - ts).alias("lost"), F.round(seconds, 3).alias("seconds"), text.relative_age(seconds, F.col("ts").cast("timestamp")).alias("age"))


def split_lists(spark, d):
    listed = F.concat_ws(",", F.concat(F.lit(" "), F.col("event_type")), F.lit(""), F.concat(F.lit("\t x"), F.col("k").cast("string"), F.lit(" ")), F.when(F.col("k") % 2 == 0, F.lit("  ")))
    return _log(spark, d).select("event_id", F.array_join(text.split_list(F.regexp_replace(listed, "\t", " ")), "|").alias("parts"))


def clipped_texts(spark, d):
    t = F.coalesce("text", F.lit(""))
    return _t(spark, d, "documents").select("doc_id", F.md5(text.clip(t, 60).cast("binary")).alias("clipped"), text.pad(text.clip(F.col("source"), 4), 6, right=True).alias("padded"))


def topic_names(spark, d):
    """Records of each topic of the whole log: main, retry tiers and dead letters in one table."""
    routed = _routed(spark, d)
    retried = republish.escalate(routed.withColumns({"headers": headers.encode_headers({"x": F.lit(1)}), "timestamp_ms": F.lit(0)}), F.lit(0).cast("long"), F.lit(NOW)).select("topic")
    dead = _letter_log(spark, d).select("topic")
    return observe.counter(routed.select("topic").unionByName(retried).unionByName(dead), "topic")


_LETTER = f"""(SELECT *, CASE WHEN k % 5 <> 0 THEN event_type END AS key, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM {_ROUTED} WHERE outcome = 'dead-lettered') AS letters"""
_MESSAGE = "CASE WHEN error_type = 'permanent' THEN 'validation: bad' ELSE 'bad' END"
_WAITING = f"(SELECT *, CASE k % 4 WHEN 0 THEN 'orders.retry.5s' WHEN 1 THEN 'orders.retry.30s' WHEN 2 THEN 'orders.retry.5m' ELSE 'orders.retry.old' END AS retry_topic, CASE WHEN k % 9 = 0 THEN \"offset\" + 800 ELSE 0 END AS wait FROM {_LOG}) AS waiting"
_GATED = f"(SELECT *, max(wait) OVER (PARTITION BY retry_topic, partition ORDER BY \"offset\" ROWS UNBOUNDED PRECEDING) <= 1000 AS due FROM {_WAITING}) AS gated"
_STATE = "(SELECT concat('p', k) AS product, k % 3 AS home, row_number() OVER (PARTITION BY k % 3 ORDER BY event_id) - 1 AS \"offset\", * FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)) AS states"
_FAULTS = """(SELECT (l_orderkey * 8 + l_linenumber) % 16 AS f, l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS o, concat('Item', l_suppkey) AS p, CAST(l_extendedprice AS FLOAT) AS price FROM lineitem) AS faults"""


def _fast(metric: str, label: str, seconds: str) -> str:
    bounds = ", ".join(f"('{float(b)}', {float(b)}::DOUBLE)" for b in observe.FAST)
    return f"SELECT '{metric}' AS metric, {label} AS label, le, count(*) FILTER ({seconds} <= b) AS n, count(*) AS total, round(sum({seconds}), 2) AS sum FROM {_ROUTED}, (VALUES {bounds}, ('+Inf', 'infinity'::DOUBLE)) AS bounds(le, b) GROUP BY {label}, le"


_AGE = "(SELECT *, greatest(0, (epoch_us(ts) // 1000) + (k - 20) * 100 - CASE WHEN k % 2 = 0 THEN (epoch_us(ts) // 1000) - k * 60000 ELSE (epoch_us(ts) // 1000) END) / 1000 AS s, CAST(floor(s + 0.5) AS BIGINT) AS whole, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso FROM " + _LOG + ") AS ages"
ORACLE = {
    "decode_job": f"""SELECT schema_id, error_reason, error_message, count(*) AS n, count(*) FILTER (error_reason IS NULL) AS orders, round(sum(CASE WHEN error_reason IS NULL THEN CAST(price AS DOUBLE) END), 0) AS price FROM (SELECT *,
 CAST(CASE WHEN f <= 2 THEN NULL WHEN f = 3 THEN 999999 WHEN f = 8 THEN 8 ELSE 7 END AS INT) AS schema_id,
 CASE WHEN f IN (0, 1, 2, 4, 5) THEN 'deserialization' WHEN f IN (3, 8) THEN 'unknown-schema-id' WHEN f IN (6, 7) THEN 'validation' END AS error_reason,
 CASE f WHEN 0 THEN 'record value is null' WHEN 1 THEN 'expected magic byte 0x00, found 0x7b' WHEN 2 THEN 'payload is 3 bytes; Confluent framing requires at least 5' WHEN 3 THEN 'no schema has id 999999' WHEN 8 THEN 'no schema has id 8'
 WHEN 4 THEN 'decode failed for schema id 7: payload ends before the record does' WHEN 5 THEN 'decode failed for schema id 7: bytes follow the record' WHEN 6 THEN 'orderId: orderId must not be empty' WHEN 7 THEN 'product: product must not be empty; price: price must not be negative' END AS error_message FROM {_FAULTS}) GROUP BY 1, 2, 3""",
    "decode_versions": """SELECT CAST(id AS INT) AS schema_id, CASE id WHEN 1 THEN 'EUR' WHEN 2 THEN 'LKR' END AS currency, CASE WHEN id = 2 AND l_linenumber % 2 = 0 THEN l_linestatus END AS note, CASE id WHEN 3 THEN 'price: string cannot be read as double' WHEN 4 THEN 'product: missing without default' END AS error,
 count(*) AS n, count(*) FILTER (id < 3) AS products, CAST(sum(CASE WHEN id < 3 THEN l_orderkey END) AS BIGINT) AS ids, round(sum(CASE id WHEN 1 THEN CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) WHEN 2 THEN floor(l_extendedprice) END), 0) AS price
 FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN 4 WHEN l_linenumber = 6 THEN 3 ELSE l_orderkey % 2 + 1 END AS id FROM lineitem) GROUP BY 1, 2, 3, 4""",
    "schema_verdicts": "SELECT n_nationkey, n_nationkey % 4 < 2 AS accepted, CASE n_nationkey % 4 WHEN 2 THEN 'price: string cannot be read as double' WHEN 3 THEN 'product: missing without default' ELSE '' END AS detail FROM nation",
    "valid_orders": "SELECT l_returnflag, l_orderkey % 7 <> 0 AND l_suppkey % 3 <> 0 AND l_extendedprice >= 0 AS valid, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "format_orders": "SELECT l_orderkey, printf('%d Item%d %.2f', l_orderkey, l_suppkey, l_extendedprice) AS line FROM lineitem WHERE l_linenumber = 1",
    "marker_failures": f"SELECT event_id, k % 4 = 0 AND k % 5 + 1 < 4 AS fails FROM {_LOG}",
    "registry_errors": f"SELECT event_id, [409, 422, 404, 401, 403, 500, 503][k % 7 + 1] AS status, CASE WHEN k % 7 < 3 THEN 'permanent' ELSE 'transient' END AS kind, CASE WHEN k % 7 < 2 THEN 'schema-incompatible' WHEN k % 7 = 2 THEN 'unknown-schema-id' END AS reason FROM {_LOG}",
    "describe_errors": f"SELECT event_id, CASE k % 3 WHEN 0 THEN concat('broken ', k) WHEN 1 THEN concat('{{\"code\":', k, ',\"at\":\"', event_type, '\"}}') ELSE 'undefined' END AS message FROM {_LOG}",
    "dlq_write": f"SELECT 'orders.dlq' AS topic, partition, \"offset\", key, CAST(event_id AS VARCHAR) AS value, CAST(CASE WHEN k % 2 = 0 THEN 15 ELSE 14 END AS BIGINT) AS n, false AS other FROM {_LETTER}",
    "dlq_metadata": f"""SELECT partition, "offset", topic AS original_topic, CAST(partition AS BIGINT) AS original_partition, CAST("offset" AS VARCHAR) AS original_offset, (epoch_us(ts) // 1000) AS original_timestamp, coalesce(key, '') AS original_key, error_type, CASE WHEN k % 2 = 0 THEN 'Error' END AS error_class, {_MESSAGE} AS error_message,
 CAST(0 AS BIGINT) AS error_stack, CAST(k % 5 AS BIGINT) AS attempt, '{NOW}' AS first_failed_at, '{NOW}' AS last_failed_at, 'group' AS consumer_group, CASE WHEN k % 4 = 0 THEN concat('correlation-', k) ELSE '' END AS correlation_id, '1.0' AS app_version, CAST(NULL AS VARCHAR) AS replayed_from_offset, CAST(NULL AS BIGINT) AS replay_count FROM {_LETTER}""",
    "dlq_list_rows": f"SELECT partition, \"offset\", replace(iso, 'T', ' ')[1:19] AS written_at, error_type, CASE WHEN k % 2 = 0 THEN 'Error' ELSE '?' END AS error_class, {_MESSAGE} AS reason, concat('orders[', partition, ']@', \"offset\") AS origin, CAST(k % 5 AS VARCHAR) AS attempt, coalesce(key, '') AS key, CASE WHEN k % 4 = 0 THEN 'correlat' ELSE '' END AS correlation_id, '' AS replays FROM {_LETTER}",
    "dlq_listing": f"WITH l AS (SELECT * FROM {_LETTER}), newest AS (SELECT * FROM l ORDER BY partition DESC, \"offset\" DESC LIMIT 50) SELECT error_type, count(*) AS n, (SELECT count(*) FROM newest) AS shown, (SELECT count(*) FROM l) AS total FROM newest GROUP BY 1",
    "dlq_select_offsets": f"SELECT event_id, partition, \"offset\" FROM {_ROUTED} WHERE outcome = 'dead-lettered' AND \"offset\" IN (SELECT \"offset\" FROM {_LOG} WHERE k = 12)",
    "dlq_replay": f"SELECT \"offset\" AS dlq_offset, 'orders' AS target, count(*) AS n, CAST(sum(CASE WHEN \"offset\" % 2 = 0 THEN \"offset\" + 1 ELSE 1 END) AS BIGINT) AS replays, 'x-app-version,x-correlation-id,x-replay-count,x-replayed-at,x-replayed-from-dlq-offset' AS names, CAST(sum(event_id) AS BIGINT) AS ids FROM {_LETTER} WHERE \"offset\" >= 100 GROUP BY \"offset\"",
    "changelog_restore": f"SELECT product, CAST(home AS INT) AS partition, \"offset\" AS last_offset, \"offset\" + 1 AS count, value AS mean, (epoch_us(ts) // 1000) AS last_updated FROM {_STATE} WHERE home IN (0, 2) AND \"offset\" % 10 > 2 QUALIFY row_number() OVER (PARTITION BY product ORDER BY \"offset\" DESC) = 1",
    "changelog_skipped": f"SELECT count(*) FILTER (\"offset\" % 10 = 0) AS empty, count(*) FILTER (\"offset\" % 10 IN (1, 2)) AS bad FROM {_STATE}",
    "changelog_compact": f"SELECT product AS key, CAST(home AS INT) AS partition, \"offset\", \"offset\" % 10 = 0 AS empty FROM {_STATE} QUALIFY row_number() OVER (PARTITION BY product ORDER BY \"offset\" DESC) = 1",
    "dropped_entries": f"SELECT count(*) FILTER (partition = 0) AS dropped FROM {_LOG}",
    "last_offsets": f"SELECT k, \"offset\" AS last_offset FROM {_LOG} QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, partition DESC, \"offset\" DESC) = 1",
    "product_count": "SELECT count(DISTINCT l_partkey) AS keys FROM lineitem",
    "product_lookup": f"SELECT event_type AS key, {_sql('value', 'ts', MANY)} FROM events WHERE event_type = 'click' GROUP BY 1",
    "state_view": "SELECT user_id, count(v) AS count, round(coalesce(avg(v), 0), 6) AS mean, min(v) AS min, max(v) AS max, round(var_samp(v), 4) AS variance, round(stddev_samp(v), 4) AS stddev, CASE WHEN count(v) > 0 THEN strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS last_updated FROM (SELECT *, CASE WHEN user_id % 5 <> 0 THEN value END AS v FROM events) GROUP BY user_id",
    "distinct_orders": f"SELECT k, event_id, partition, \"offset\" FROM {_LOG} QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts, event_id) = 1",
    "total_lag": f"SELECT CAST(sum(a.\"end\" - b.committed) AS BIGINT) AS total FROM (SELECT partition, max(\"offset\") + 1 AS \"end\" FROM {_LOG} GROUP BY 1) a JOIN (SELECT partition, max(\"offset\") + 1 AS committed FROM {_LOG} WHERE partition < 2 AND k < 50 GROUP BY 1) b ON a.partition = b.partition",
    "retried_by_tier": f"SELECT CASE k % 5 WHEN 0 THEN '5s' WHEN 1 THEN '30s' ELSE '5m' END AS tier, count(*) AS n FROM {_ROUTED} WHERE outcome = 'retried' GROUP BY 1",
    "forwarded_by_tier": f"SELECT CASE WHEN retry_topic = 'orders.retry.old' THEN retry_topic ELSE replace(retry_topic, 'orders.retry.', '') END AS tier, count(*) AS n FROM {_GATED} WHERE due GROUP BY 1",
    "paused_partitions": f"SELECT count(DISTINCT (retry_topic, partition)) AS partitions, count(*) AS records FROM {_GATED} WHERE NOT due",
    "forward_outcomes": f"SELECT event_id, 'orders' AS topic, retry_topic, 'forwarded' AS outcome FROM {_GATED} WHERE due",
    "batch_counts": "SELECT count(*) AS handled, count(*) FILTER (user_id % 10 <> 0) AS committed, count(DISTINCT CASE WHEN user_id % 10 = 0 THEN user_id END) AS failed FROM events",
    "duration_histograms": " UNION ALL ".join([_fast("order_processing_duration_seconds", "outcome", "(value / 100)"), _fast("offset_commit_duration_seconds", "topic", "(CAST(k AS DOUBLE) / 100)"), _fast("changelog_write_duration_seconds", "topic", "(CAST(k AS DOUBLE) / 10 / 100)")]),
    "times_and_ages": f"SELECT event_id, iso, replace(iso, 'T', ' ')[1:19] AS shown, CAST(0 AS BIGINT) AS lost, round(s, 3) AS seconds, CASE WHEN whole < 5 THEN 'just now' WHEN whole < 60 THEN concat(whole, ' s ago') WHEN whole < 3600 THEN concat(CAST(floor(whole / 60 + 0.5) AS BIGINT), ' min ago') ELSE strftime(ts, '%H:%M:%S') END AS age FROM {_AGE}",
    "split_lists": f"SELECT event_id, concat(event_type, '|x', k) AS parts FROM {_LOG}",
    "clipped_texts": "SELECT doc_id, md5(CASE WHEN length(coalesce(text, '')) > 60 THEN concat(substring(text, 1, 59), '…') ELSE coalesce(text, '') END) AS clipped, CASE WHEN length(source) > 4 THEN concat('  ', substring(source, 1, 3), '…') ELSE lpad(source, 6, ' ') END AS padded FROM documents",
    "topic_names": f"SELECT topic, count(*) AS n FROM (SELECT topic FROM {_LOG} UNION ALL SELECT concat('orders.retry.', CASE k % 5 WHEN 0 THEN '5s' WHEN 1 THEN '30s' ELSE '5m' END) FROM {_ROUTED} WHERE outcome = 'retried' UNION ALL SELECT 'orders.dlq' FROM {_ROUTED} WHERE outcome = 'dead-lettered') GROUP BY 1",
}


def queries() -> dict:
    every = (decode_job, decode_versions, schema_verdicts, valid_orders, format_orders, marker_failures, registry_errors, describe_errors, dlq_write, dlq_metadata, dlq_list_rows, dlq_listing, dlq_select_offsets, dlq_replay, changelog_restore, changelog_skipped, changelog_compact, dropped_entries, last_offsets, product_count, product_lookup, state_view, distinct_orders, total_lag, retried_by_tier, forwarded_by_tier, paused_partitions, forward_outcomes, batch_counts, duration_histograms, times_and_ages, split_lists, clipped_texts, topic_names)
    return {f.__name__: f for f in every}
