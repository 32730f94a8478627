"""Figures of running streams: observed in the batches, gathered by a listener in a table of batches, shown as counters and histograms."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tallyflow.operators.observe import END_TO_END, FAST, histogram
from tallyflow.operators.routing import OUTCOMES
from tallyflow.sources.segments import Store

#: Name of the figures that ``observed`` adds to a stream.
NAME = "routed"
BATCHES = "query string, name string, batch_id long, committed boolean, handled long, processing_ms long, commit_ms long, write_ms long, lag map<string,long>, figures map<string,double>, at string"


def observed(routed: DataFrame, now_ms=None, origin_ms=None) -> DataFrame:
    """A stream of routed records whose batches tell their outcomes, retries by tier, dead letters by type and, where times are given, seconds from end to end in buckets. It costs no pass of its own."""
    o = F.col("outcome")
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    figures = [count(o == x, f"outcome {x}") for x in OUTCOMES]
    figures += [count((o == "retried") & (F.col("tier") == t), f"tier {t}") for t in ("5s", "30s", "5m")]
    figures += [count((o == "dead-lettered") & (F.col("error_type") == t), f"type {t}") for t in ("permanent", "transient-exhausted")]
    if now_ms is not None:
        seconds = F.greatest(F.lit(0), now_ms - origin_ms) / 1000
        figures += [count(seconds <= b, f"le {float(b)}") for b in END_TO_END] + [count(seconds.isNotNull(), "le +Inf"), F.coalesce(F.sum(seconds), F.lit(0.0)).alias("seconds")]
    return routed.observe(NAME, *figures)


class MetricsLog(StreamingQueryListener):
    """Writes a small file for each batch of the session's streams under ``path``: nothing is kept in the driver. A failed query has a row that is not committed; where a lag cannot be read, the query's last one stands."""

    def __init__(self, path: str):
        self.store = Store(path)
        self.store.fs.create_dir(self.store.root, recursive=True)
        self.lags: dict[str, dict] = {}

    def _add(self, row: dict) -> None:
        name = f"{self.store.root}/{row['query']}-{row['batch_id']}-{uuid.uuid4().hex[:8]}.json"
        with self.store.fs.open_output_stream(name) as out:
            out.write(json.dumps(row).encode())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        took = dict(p.durationMs)
        try:
            self.lags[str(p.id)] = {k: v for s in p.sources for k, v in source_lag(s.endOffset, s.latestOffset, dict(s.metrics)).items()}
        except (TypeError, ValueError, KeyError):
            pass
        figures = p.observedMetrics.get(NAME)
        row = {"query": str(p.id), "name": p.name, "batch_id": p.batchId, "committed": True, "handled": p.numInputRows, "processing_ms": int(took.get("triggerExecution", 0)), "commit_ms": int(took.get("commitOffsets", 0)), "write_ms": int(took.get("addBatch", 0)), "at": p.timestamp}
        self._add(row | {"lag": self.lags.get(str(p.id), {}), "figures": {k: float(v) for k, v in figures.asDict().items()} if figures is not None else {}})

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self._add({"query": str(event.id), "name": None, "batch_id": -1, "committed": False, "handled": 0, "processing_ms": 0, "commit_ms": 0, "write_ms": 0, "lag": self.lags.get(str(event.id), {}), "figures": {}, "at": None})
        self.lags.pop(str(event.id), None)


def source_lag(end: str | None, latest: str | None, metrics: dict) -> dict[str, int]:
    """Records of each partition that a batch has left unread, from a segment log's positions, or else the most that the source tells."""
    position = json.loads(end) if end else None
    if isinstance(position, dict) and "ends" in position:
        newest = json.loads(latest)["ends"] if latest else position["ends"]
        return {place: n - position["ends"].get(place, 0) for place, n in newest.items()}
    return {"all": int(metrics["maxOffsetsBehindLatest"])} if "maxOffsetsBehindLatest" in metrics else {}


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The table of batches: a row for each that has ended, or failed (batch -1)."""
    return spark.read.schema(BATCHES).json(path)


def counters(table: DataFrame, prefix: str, label: str) -> DataFrame:
    """label and n: sums over all batches of the figures that begin with ``prefix`` (outcome, tier, type)."""
    return table.select(F.explode("figures").alias("k", "v")).where(F.col("k").startswith(f"{prefix} ")).groupBy(F.substring("k", len(prefix) + 2, 1 << 20).alias(label)).agg(F.sum("v").cast("long").alias("n"))


def durations(table: DataFrame) -> DataFrame:
    """metric, le, n, total and sum (seconds) of batches: their processing, their commits of positions and their writes."""
    metrics = {"order_processing_duration_seconds": "processing_ms", "offset_commit_duration_seconds": "commit_ms", "changelog_write_duration_seconds": "write_ms"}
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), (F.col(c) / 1000).alias("seconds")) for m, c in metrics.items()]))
    return histogram(table.where("committed").select(each.alias("x")).select("x.*"), "metric", "seconds", FAST)


def end_to_end(table: DataFrame) -> DataFrame:
    """le, n, total and sum of the seconds from end to end of all records."""
    one = table.select(F.explode("figures").alias("k", "v"))
    sums = one.groupBy("k").agg(F.sum("v").alias("v"))
    total = sums.agg(F.max(F.when(F.col("k") == "le +Inf", F.col("v"))).cast("long").alias("total"), F.max(F.when(F.col("k") == "seconds", F.col("v"))).alias("sum"))  # one row
    return sums.where("k like 'le %'").select(F.substring("k", 4, 99).alias("le"), F.col("v").cast("long").alias("n")).join(F.broadcast(total))


def totals(table: DataFrame) -> DataFrame:
    """One row: records handled, records of committed batches, failed batches."""
    done = F.when(F.col("committed"), F.col("handled"))
    return table.agg(F.coalesce(F.sum("handled"), F.lit(0)).alias("handled"), F.coalesce(F.sum(done), F.lit(0)).alias("committed"), F.count(F.when(~F.col("committed"), 1)).alias("failed"))


def newest_lag(table: DataFrame) -> DataFrame:
    """query, place and lag of each query's newest batch that has one."""
    newest = table.where("size(lag) > 0").groupBy("query").agg(F.max_by("lag", F.struct("at", "batch_id")).alias("lag"))
    return newest.select("query", F.explode("lag").alias("place", "lag"))
