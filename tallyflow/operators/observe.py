"""Operational figures: histograms, throughput, lag and depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bucket bounds in seconds.
FAST = (0.001, 0.0025, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5)
END_TO_END = (0.01, 0.05, 0.1, 0.5, 1, 5, 10, 30, 60, 120, 300, 600)


def histogram(df: DataFrame, label: str, value: str, bounds) -> DataFrame:
    """label, le, cumulative n, total and sum; the last le is +Inf. One pass with a sum for each bound, then one row for each."""
    v = F.col(value)
    counted = df.where(v.isNotNull()).groupBy(label).agg(*[F.sum((v <= b).cast("long")).alias(f"b{i}") for i, b in enumerate(bounds)], F.count("*").alias("total"), F.sum(v).alias("sum"))
    rows = [F.struct(F.lit(str(float(b))).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)] + [F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("n"))]
    return counted.select(label, F.explode(F.array(*rows)).alias("x"), "total", "sum").select(label, "x.le", "x.n", "total", "sum")


def throughput(df: DataFrame, key: str, at: str, seconds: int = 10) -> DataFrame:
    """df with the records of its key in the closed last ``seconds`` a second, two decimals.

    A key's records are cut into spans of time, so that a hot key is spread over tasks. Each record counts once at its time and
    back just after it leaves the window, in its own span or the next, which begins with the records that have not left: a running sum,
    whose work does not grow with the records in a window. Records without a time count those of their key without one.
    Halves round by the double's hundredfold, as in SQL.
    """
    micros, span = F.unix_micros(F.col(at).cast("timestamp")), max(seconds, 600) * 1_000_000
    own, leaves = F.floor(micros / span).cast("long"), micros + seconds * 1_000_000 + 1
    stays = (leaves >= (own + 1) * span).cast("int")

    def mark(span, time, step, enters):
        return F.struct(span.alias("span"), time.alias("time"), F.lit(step).alias("step"), enters.alias("enters"))

    marks = F.array(mark(own, micros, 1, F.lit(0)), mark(own + stays, leaves, -1, stays))
    rows = df.select("*", F.explode(F.when(micros.isNull(), F.slice(marks, 1, 1)).otherwise(marks)).alias("__mark"))
    parts = Window.partitionBy(key, "__mark.span")
    sums = F.sum("__mark.step").over(parts.orderBy("__mark.time").rangeBetween(Window.unboundedPreceding, 0)) + F.sum("__mark.enters").over(parts)
    return rows.withColumn("per_second", F.round(sums / seconds * 100) / 100).where("__mark.step = 1").drop("__mark")


def depth(log: DataFrame) -> DataFrame:
    """Records of each topic, from the offsets of its partitions."""
    parts = log.groupBy("topic", "partition").agg((F.max("offset") + 1 - F.min("offset")).alias("depth"))
    return parts.groupBy("topic").agg(F.sum("depth").alias("depth"))


def lag(ends: DataFrame, committed: DataFrame, owned=()) -> DataFrame:
    """partition, end, committed, lag and owned, by partition; without a commit the lag is null."""
    known = F.when(F.col("committed").isNotNull(), F.greatest(F.lit(0), F.col("end") - F.col("committed")))
    return ends.join(committed, "partition", "left").select("partition", "end", "committed", known.alias("lag"), F.col("partition").isin(*owned).alias("owned")).orderBy("partition")


def total_lag(lags: DataFrame) -> DataFrame:
    """One row: the sum of the known lags; null where none is known."""
    return lags.agg(F.sum("lag").alias("total"))


def counter(rows: DataFrame, label: str, domain=()) -> DataFrame:
    """label and n: rows of each value, zeros for the values of ``domain`` that do not occur."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    if not domain:
        return counts
    every = rows.sparkSession.createDataFrame([(x,) for x in domain], f"{label} string")
    return every.join(counts, label, "full").select(label, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def forwarded_by_tier(forwarded: DataFrame, tiers: DataFrame, topic: str = "retry_topic") -> DataFrame:
    """tier and n of forwarded records: the label of the topic where they waited, or that topic's name where no tier has it."""
    known = F.broadcast(tiers.select(F.col("tier_topic").alias(topic), "label"))  # a row for each tier
    return counter(forwarded.join(known, topic, "left").withColumn("tier", F.coalesce("label", topic)), "tier")


def held_partitions(gated: DataFrame, partition: list[str]) -> DataFrame:
    """One row from records with due: how many partitions are held (paused), and how many records wait in them."""
    held = gated.where("not due").groupBy(*partition).agg(F.count("*").alias("n"))
    return held.agg(F.count("*").alias("partitions"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"))


def batch_counts(runs: DataFrame) -> DataFrame:
    """One row of a table of batches (handled, committed: boolean): records handled, records of committed batches, failed batches."""
    return runs.agg(F.coalesce(F.sum("handled"), F.lit(0)).alias("handled"), F.coalesce(F.sum(F.when(F.col("committed"), F.col("handled"))), F.lit(0)).alias("committed"), F.count(F.when(~F.col("committed"), 1)).alias("failed"))
