"""Streams with one table a batch: keyed running statistics with checkpointed state, and the outcome router."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tallyflow.operators.routing import due, route
from tallyflow.operators.stats import fold, merge_states
from tallyflow.sources.segments import append_log


def stats_stream(stream: DataFrame, key: str, value: str, at: str, table: str, checkpoint: str):
    """Starts the query: each batch writes the keys that changed under table/batch_id=n, overwriting, so that a repeated batch does no harm. Reads what is available and stops; a restart goes on from the checkpoint."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={number}")

    return fold(stream, key, value, at).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def latest_stats(updates: DataFrame, key: str) -> DataFrame:
    """The last written row of each key."""
    names = [c for c in updates.columns if c not in (key, "batch_id")]
    return updates.groupBy(key).agg(F.max_by(F.struct(*names), "batch_id").alias("r")).select(key, "r.*")


def router_stream(stream: DataFrame, handler: Callable[[DataFrame], DataFrame], tiers: DataFrame, table: str, checkpoint: str):
    """Starts the router: ``handler`` adds attempt and error_kind to the records, and each batch writes them once, by outcome, under table/batch_id=n.

    The input's position is committed after a batch is written. A batch that was cut off is repeated and overwrites its folder,
    so that every record ends with one outcome.
    """

    def write(batch: DataFrame, number: int) -> None:
        route(handler(batch), tiers).write.mode("overwrite").partitionBy("outcome").parquet(f"{table}/batch_id={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def snapshot_stream(stream: DataFrame, key: str, value: str, at: str, table: str, checkpoint: str, every: str | None = None):
    """Starts the query: each batch writes the whole snapshot (all keys, then the overall row) under table/batch_id=n; readers take the newest. ``every``: the least time between snapshots; without it what is there is read and the query ends.

    The stream keeps the keys' states; the overall row is merged from them in the batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select(F.col(key).cast("string").alias("key"), "count", "mean", "m2", "min", "max", "last_updated")
        every = merge_states(rows).withColumn("key", F.lit(None).cast("string"))
        rows.withColumn("overall", F.lit(False)).unionByName(every.withColumn("overall", F.lit(True))).write.mode("overwrite").parquet(f"{table}/batch_id={number}")

    query = fold(stream, key, value, at).writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    return (query.trigger(processingTime=every) if every else query.trigger(availableNow=True)).foreachBatch(write).start()


def newest_batch(rows: DataFrame) -> DataFrame:
    """The rows of the newest batch of a table of batches."""
    last = rows.agg(F.max("batch_id").alias("batch_id"))  # one row
    return rows.join(F.broadcast(last), "batch_id", "left_semi").drop("batch_id")


def gate(waiting: DataFrame, now_ms: int, topic: str = "orders") -> tuple[DataFrame, DataFrame]:
    """(forwarded, pending) of the records that wait in retry topics: a record is due only if all before it in its partition are. Forwarded ones are addressed to ``topic``, with retry_topic for where they waited and outcome."""
    gated = due(waiting, now_ms, ["topic", "partition"])
    forwarded = gated.where("due").drop("due").withColumnRenamed("topic", "retry_topic").withColumns({"topic": F.lit(topic), "outcome": F.lit("forwarded")})
    return forwarded, gated.where("not due").drop("due")


def outcome_stream(stream: DataFrame, handler: Callable[[DataFrame], DataFrame], tiers: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], table: str, checkpoint: str):
    """Starts the router with a sink for each outcome: ``sinks`` makes the records of an outcome (retry records, dead letters, state rows) from its routed rows, and each batch writes them under table/outcome/batch_id=n.

    The batch is routed once and kept while its sinks are written; the input's position is committed when all are.
    """

    def write(batch: DataFrame, number: int) -> None:
        routed = route(handler(batch), tiers).persist()
        for outcome, made in sinks.items():
            made(routed.where(F.col("outcome") == outcome)).write.mode("overwrite").parquet(f"{table}/{outcome}/batch_id={number}")
        routed.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def outcome_log_stream(stream: DataFrame, handler: Callable[[DataFrame], DataFrame], tiers: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str, writer: str, partitions: int = 12):
    """Starts the router into a segment log: ``sinks`` makes the keyed records of an outcome (topic, key, value, headers) from its routed rows.

    All outcomes of a batch are one commit of the log, and the input's position is stored after it: wherever a batch is cut off,
    readers see all its outcomes or none, and a repeated batch adds nothing to what ``writer`` has committed.
    """

    def write(batch: DataFrame, number: int) -> None:
        routed = route(handler(batch), tiers).persist()
        parts = [made(routed.where(F.col("outcome") == outcome)).select("topic", "key", "value", "timestamp", "headers") for outcome, made in sinks.items()]
        append_log(reduce(DataFrame.unionByName, parts), path, writer, number, partitions)
        routed.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


class BatchLog(StreamingQueryListener):
    """One record for each batch of the session's streams: what it handled, how long its steps took and how far its sources lag; a failed sample keeps the last good figures."""

    def __init__(self):
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        took = dict(p.durationMs)
        try:
            lags = [int(s.metrics.get("maxOffsetsBehindLatest", 0)) for s in p.sources]
        except (TypeError, ValueError):
            lags = [self.rows[-1][5]] if self.rows else [0]
        self.rows.append((str(p.id), p.batchId, p.numInputRows, int(took.get("addBatch", 0)), int(took.get("commitOffsets", 0)), max(lags, default=0), True))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.rows.append((str(event.id), -1, 0, 0, 0, 0, False))

    def table(self, spark: SparkSession) -> DataFrame:
        """query, batch_id, handled, sink_ms, commit_ms, lag and committed: the input of ``observe.batch_counts`` and, in seconds, of ``observe.histogram``."""
        return spark.createDataFrame(self.rows, "query string, batch_id long, handled long, sink_ms long, commit_ms long, lag long, committed boolean")
