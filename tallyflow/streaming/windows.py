"""Event time in streams: throughput by sliding windows, and orders once within a delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def throughput_windows(records: DataFrame, key: str, at: str, seconds: int = 10, slide: int = 1, late: str | None = "10 seconds") -> DataFrame:
    """key, window_start, window_end, n and per_second (two decimals) of sliding windows [start, end), for tables and streams alike.

    In a stream a window is told once, when it is closed: when the records have come ``late`` past its end. Older records are
    then left out, and the windows' counts leave the state. A record adds to seconds / slide counts, combined before the shuffle.
    """
    rows = records.where(F.col(at).isNotNull()).select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("at"))
    if records.isStreaming and late:
        rows = rows.withWatermark("at", late)
    counted = rows.groupBy("key", F.window("at", f"{seconds} seconds", f"{slide} seconds").alias("w")).agg(F.count("*").alias("n"))
    return counted.select(F.col("key").alias(key), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", F.round(F.col("n") / seconds, 2).alias("per_second"))


def distinct_stream(records: DataFrame, order_id: str, at: str, within: str) -> DataFrame:
    """A stream's records without those whose order id has come before, for as long as ``within`` after the first of it; then its id leaves the state. The state lives in the query's checkpoint, so restarts change nothing. Records without order id are all kept."""
    marked = records.withWatermark(at, within)
    known = marked.where(F.col(order_id).isNotNull()).dropDuplicatesWithinWatermark([order_id])
    return known.unionByName(marked.where(F.col(order_id).isNull()))
