"""Queries whose work is done by streams, state and logs over the given tables, with what they come to in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.headers import encode_headers
from tallyflow.operators import changelog, routing
from tallyflow.operators.handler import handle, permanent, transient
from tallyflow.operators.state_table import StateTable
from tallyflow.plans.log_queries import _STATE, _states
from tallyflow.plans.queries import _LOG, _ROUTED, _log, _t
from tallyflow.sources.log import tier_table
from tallyflow.sources.segments import append_log, scan_log
from tallyflow.streaming import metrics, stateful
from tallyflow.streaming.folders import drained, table_stream, work_folder
from tallyflow.streaming.windows import distinct_stream, throughput_windows


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def state_store_stats(spark, d) -> DataFrame:
    """Running statistics by event type, folded by a stream into its state store and read back from there."""
    folder = work_folder(spark, "state")
    records = table_stream(spark, d, "events").withColumn("partition", (F.col("user_id") % 3).cast("int"))
    states = stateful.running_states(records, "event_type", "value", "ts", offset="event_id")
    drained(states.writeStream.outputMode("update").format("noop"), folder)
    rows = stateful.read_states(spark, folder)
    return rows.select("key", "count", F.round("mean", 6).alias("mean"), F.round("m2", 1).alias("m2"), "min", "max", "last_updated", "partition", "last_offset")


def changelog_start(spark, d) -> DataFrame:
    """Statistics of a stream that starts from a changelog: events of the first half are in the changelog, the stream folds the others."""
    folder = work_folder(spark, "start")
    e = _t(spark, d, "events").select("event_type", "value", "ts", F.lit(0).alias("partition"), F.col("event_id").alias("offset"))
    figures = e.where("offset % 2 = 0").groupBy("event_type").agg(F.count("value").alias("count"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2"), F.min("value").alias("min"), F.max("value").alias("max"), F.max("ts").cast("timestamp").alias("last_updated"), F.max("offset").alias("last_offset"))
    log = changelog.encode(figures.withColumns({"product": F.col("event_type"), "partition": F.lit(0)}), "partition", "last_offset").withColumns({"topic": F.lit("state"), "offset": F.col("last_offset"), "timestamp": F.current_timestamp()})
    late = table_stream(spark, d, "events").where("event_id % 2 = 1").withColumn("partition", F.lit(0))
    states = stateful.running_states(late, "event_type", "value", "ts", changelog.restore(log), offset="event_id")
    drained(states.writeStream.outputMode("update").format("noop"), folder)
    return stateful.read_states(spark, folder).select("key", "count", F.round("mean", 6).alias("mean"), F.round("m2", 1).alias("m2"), "min", "max", "last_updated", "last_offset")


def closed_windows(spark, d) -> DataFrame:
    """Throughput of event types in windows of a day each half day, told by a stream once they are closed."""
    folder = work_folder(spark, "windows")
    rows = throughput_windows(table_stream(spark, d, "events"), "event_type", "ts", 86_400, 43_200, "1 day")
    drained(rows.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out"), f"{folder}/check")
    out = spark.read.schema(rows.schema).parquet(f"{folder}/out")
    return out.select("event_type", F.unix_millis("window_end").alias("window_end"), "n", "per_second")


def distinct_keys_stream(spark, d) -> DataFrame:
    """The keys of the events whose first record a stream lets through."""
    folder = work_folder(spark, "distinct")
    rows = distinct_stream(table_stream(spark, d, "events").select(_k().alias("k"), F.col("ts").cast("timestamp").alias("ts")), "k", "ts", "3650 days")
    drained(rows.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out"), f"{folder}/check")
    return spark.read.schema(rows.schema).parquet(f"{folder}/out").groupBy("k").agg(F.count("*").alias("n"))


def delay_queue_stream(spark, d) -> DataFrame:
    """The events that a delay queue forwards when all but a few are due: those of which none waits before them in their partition."""
    folder = work_folder(spark, "delay")
    wait = F.when((F.col("k") == 99) & (F.col("offset") > 100), F.lit(1 << 45)).otherwise(F.lit(0))
    log = _log(spark, d).select(F.lit("orders.retry.5s").alias("topic"), "partition", "offset", F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").cast("binary").alias("key"), F.col("event_id").cast("string").cast("binary").alias("value"), encode_headers({"x-retry-not-before": wait}).alias("headers"))
    log.write.parquet(f"{folder}/in")
    waiting = stateful.waiting_records(spark.readStream.schema(log.schema).parquet(f"{folder}/in"))
    out = stateful.delay_queue(waiting).writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append")
    query = out.option("checkpointLocation", f"{folder}/check").trigger(processingTime="1 day").start()
    while query.lastProgress is None and query.isActive:  # one batch; what waits keeps such a query running
        query.awaitTermination(0.2)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stateful.FORWARDED).parquet(f"{folder}/out").select(F.col("value").cast("string").cast("long").alias("event_id"), "topic", "retry_topic", "partition", "offset")


def state_table(spark, d) -> DataFrame:
    """The changelog's states in a table of levels: six batches, merged as they come, read for two partitions."""
    rows = changelog.entries(changelog.decode(_states(spark, d))).drop("log_timestamp").persist()
    table = StateTable(spark, work_folder(spark, "levels"), order=("log_partition", "log_offset"), fanout=2)
    for n in range(6):
        table.append(rows.where(F.col("log_offset") % 6 == n), "query", n)
    rows.unpersist()
    return table.read([0, 2]).select("product", "partition", "last_offset", "count", "mean", F.unix_millis("last_updated").alias("last_updated"))


def segment_log(spark, d) -> DataFrame:
    """The events written to a log in two commits and scanned: per key its records, the partitions they lie in, and whether these have gapless offsets."""
    path = work_folder(spark, "log")
    e = _t(spark, d, "events").select("event_id", F.lit("orders").alias("topic"), F.col("event_type").cast("binary").alias("key"), F.col("event_id").cast("string").cast("binary").alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))
    for half in (0, 1):
        append_log(e.where(F.col("event_id") % 2 == half), path, writer="query", batch=half)
    append_log(e.where("event_id % 2 = 1"), path, writer="query", batch=1)  # again: left out
    rows = scan_log(spark, path, ["orders"], timeout_ms=3_600_000)
    gapless = rows.groupBy("partition").agg((F.max("offset") + 1 == F.count_distinct("offset")).alias("gapless"))
    each = rows.groupBy("key", "partition").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("string").cast("long")).alias("ids"))
    return each.join(gapless, "partition").groupBy(F.col("key").cast("string").alias("event_type")).agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"), F.count("*").alias("partitions"), F.min("gapless").alias("gapless"))


def handled_records(spark, d) -> DataFrame:
    """Outcomes of a handler that refuses some events, fails for a while on others and dies of a few: each by itself."""

    def handler(batch, attempt):
        if (batch["k"] == 13).any():
            raise ValueError("thirteen")
        errors = [permanent(f"bad {k}", "validation") if k % 11 == 0 else transient("outage") if k % 7 == 0 else transient("busy") if k % 5 == 0 and attempt < 2 else None for k in batch["k"]]
        return errors

    rows = handle(_log(spark, d).select("event_id", "k"), handler, base_ms=1, at_once=200)
    return rows.select("event_id", "error_kind", "error_reason", "error_message", "tries")


def batch_metrics(spark, d) -> DataFrame:
    """Outcomes of the routed events as the running stream's batches tell them, from the table of batches."""
    folder = work_folder(spark, "metrics")
    rows = table_stream(spark, d, "events").withColumn("k", _k())
    rows = rows.withColumn("attempt", (F.col("k") % 5).cast("int")).withColumn("error_kind", F.when(F.col("k") % 3 == 0, "transient").when(F.col("k") % 11 == 0, "permanent"))
    listener = metrics.MetricsLog(f"{folder}/batches")
    spark.streams.addListener(listener)
    drained(metrics.observed(routing.route(rows, tier_table(spark))).writeStream.format("noop"), f"{folder}/check")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    table = metrics.batches(spark, f"{folder}/batches")
    return metrics.counters(table, "outcome", "outcome").unionByName(metrics.counters(table, "tier", "outcome"))


_STATS = "count(value) AS count, round(avg(value), 6) AS mean, round(var_pop(value) * count(value), 1) AS m2, min(value) AS min, max(value) AS max, epoch_us(max(ts)) // 1000 AS last_updated"
ORACLE = {
    "state_store_stats": f"SELECT event_type AS key, {_STATS}, CAST(arg_max(user_id % 3, event_id) AS INT) AS partition, max(event_id) AS last_offset FROM events GROUP BY 1",
    "changelog_start": f"SELECT event_type AS key, {_STATS}, max(event_id) AS last_offset FROM events GROUP BY 1",
    "closed_windows": """SELECT event_type, e * 1000 AS window_end, count(*) AS n, round(count(*) / 86400.0, 2) AS per_second FROM (SELECT event_type, (epoch_us(ts) // 43200000000 + s) * 43200 AS e FROM events, (VALUES (1), (2)) AS v(s)) WHERE e * 1000 <= (SELECT epoch_us(max(ts)) // 1000 - 86400000 FROM events) GROUP BY 1, 2""",
    "distinct_keys_stream": f"SELECT DISTINCT k, CAST(1 AS BIGINT) AS n FROM {_LOG}",
    "delay_queue_stream": f"SELECT event_id, 'orders' AS topic, 'orders.retry.5s' AS retry_topic, partition, \"offset\" FROM (SELECT *, max(CASE WHEN k = 99 AND \"offset\" > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY partition ORDER BY \"offset\" ROWS UNBOUNDED PRECEDING) AS m FROM {_LOG}) WHERE m = 0",
    "state_table": f"SELECT product, CAST(home AS INT) AS partition, \"offset\" AS last_offset, \"offset\" + 1 AS count, value AS mean, (epoch_us(ts) // 1000) AS last_updated FROM {_STATE} WHERE home IN (0, 2) AND \"offset\" % 10 > 2 QUALIFY row_number() OVER (PARTITION BY product ORDER BY \"offset\" DESC) = 1",
    "segment_log": "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(1 AS BIGINT) AS partitions, true AS gapless FROM events GROUP BY 1",
    "handled_records": f"""SELECT event_id, CASE WHEN k = 13 OR k % 11 = 0 THEN 'permanent' WHEN k % 7 = 0 THEN 'transient' END AS error_kind, CASE WHEN k = 13 THEN 'unclassified' WHEN k % 11 = 0 THEN 'validation' END AS error_reason,
 CASE WHEN k = 13 THEN 'thirteen' WHEN k % 11 = 0 THEN concat('bad ', k) WHEN k % 7 = 0 THEN 'outage' END AS error_message, CAST(CASE WHEN k = 13 OR k % 11 = 0 THEN 1 WHEN k % 7 = 0 THEN 3 WHEN k % 5 = 0 THEN 2 ELSE 1 END AS INT) AS tries FROM {_LOG}""",
    "batch_metrics": f"""SELECT o AS outcome, count(event_id) AS n FROM (VALUES ('processed'), ('retried'), ('dead-lettered'), ('forwarded')) AS v(o) LEFT JOIN {_ROUTED.replace('AS routed', 'AS r')} ON o = r.outcome GROUP BY 1
 UNION ALL SELECT CASE k % 5 WHEN 0 THEN '5s' WHEN 1 THEN '30s' ELSE '5m' END, count(*) FROM {_ROUTED} WHERE outcome = 'retried' GROUP BY 1""",
}


def queries() -> dict:
    every = (state_store_stats, changelog_start, closed_windows, distinct_keys_stream, delay_queue_stream, state_table, segment_log, handled_records, batch_metrics)
    return {f.__name__: f for f in every}
