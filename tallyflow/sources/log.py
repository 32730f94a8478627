"""The keyed log: one schema for batch and stream, Parquet folders or Kafka topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADERS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))
LOG = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
    ]
)
#: Fixed values: (attempt, label, delay in milliseconds) of the retry tiers.
TIERS = ((1, "5s", 5_000), (2, "30s", 30_000), (3, "5m", 300_000))


def topic_names(prefix: str = "orders") -> dict[str, str]:
    """All topics of a prefix: main, a retry tier by its label, dlq and state."""
    return {"main": prefix, **{label: f"{prefix}.retry.{label}" for _, label, _ in TIERS}, "dlq": f"{prefix}.dlq", "state": f"{prefix}.aggregate.state"}


def tier_table(spark: SparkSession, prefix: str = "orders") -> DataFrame:
    """attempt, label, delay_ms, tier_topic: three rows."""
    rows = ", ".join(f"({a}, '{label}', {ms}L, '{prefix}.retry.{label}')" for a, label, ms in TIERS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(attempt, label, delay_ms, tier_topic)")


def _kafka_columns(df: DataFrame) -> DataFrame:
    return df.select("topic", F.col("partition").cast("int"), "offset", "timestamp", "key", "value", "headers")


def read_log(spark: SparkSession, path: str | None = None, topics: Sequence[str] = (), kafka: dict | None = None) -> DataFrame:
    """A bounded scan up to the end offsets at its start; later writes are left out. An empty topic gives no rows."""
    if kafka is not None:
        reader = spark.read.format("kafka").options(**kafka).option("subscribe", ",".join(topics)).option("includeHeaders", "true")
        return _kafka_columns(reader.option("startingOffsets", "earliest").option("endingOffsets", "latest").load())
    df = spark.read.schema(LOG).parquet(path)
    return df.where(F.col("topic").isin(*topics)) if topics else df


def read_log_stream(spark: SparkSession, path: str | None = None, topics: Sequence[str] = (), kafka: dict | None = None, starting: str = "earliest", max_files: int | None = None) -> DataFrame:
    """The topics as one stream. ``starting`` (earliest or latest) counts only before a checkpoint exists. Plain files have no offsets to begin from: they are read from the earliest on; ``segments.log_stream`` starts a log anywhere."""
    if kafka is None and starting != "earliest":
        raise ValueError("plain files are read from the earliest on; see segments.log_stream")
    if kafka is not None:
        reader = spark.readStream.format("kafka").options(**kafka).option("subscribe", ",".join(topics)).option("includeHeaders", "true")
        return _kafka_columns(reader.option("startingOffsets", starting).load())
    reader = spark.readStream.schema(LOG)
    df = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)
    return df.where(F.col("topic").isin(*topics)) if topics else df


def write_log(df: DataFrame, path: str | None = None, kafka: dict | None = None, mode: str = "append") -> None:
    """Appends keyed records. Kafka partitions them by key itself; files are dealt by topic and key, so that a key's records keep together."""
    if kafka is not None:
        df.select("topic", "key", "value", "headers").write.format("kafka").options(**kafka).save()
    else:
        df.select(*LOG.names).repartition("topic", "key").write.mode(mode).parquet(path)


def read_dead_letters(spark: SparkSession, path: str, topic: str = "orders.dlq") -> DataFrame:
    """The dead letters, oldest first by partition and offset."""
    return read_log(spark, path, [topic]).orderBy("partition", "offset")


def with_offsets(records: DataFrame, partition: str, order: list[str], span: Column) -> DataFrame:
    """records with offset, from 0 in each partition in the given order.

    ``span``, a column that never falls along the order, cuts the partitions: rows are counted by span, numbered within it, and
    shifted by the counts before, so that no task orders a whole partition.
    """
    rows = records.withColumn("__span", span)
    earlier = Window.partitionBy(partition).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.groupBy(partition, "__span").agg(F.count("*").alias("n")).select(partition, "__span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__ahead"))
    within = F.row_number().over(Window.partitionBy(partition, "__span").orderBy(*order)) - 1
    return rows.withColumn("__within", within).join(ahead, [partition, "__span"]).select(*records.columns, (F.col("__ahead") + F.col("__within")).cast("long").alias("offset"))
