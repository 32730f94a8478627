"""State changelog: latest row by key, drop and restore of partitions, JSON rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "struct<v:int,product:string,partition:int,lastOffset:string,state:struct<count:bigint,mean:double,m2:double,min:double,max:double,lastUpdated:bigint>>"


def latest(entries: DataFrame, key: str, order: list[str], partitions=None) -> DataFrame:
    """The last row of each key; rows of other ``partitions`` go first. An aggregate, so rows of a key combine before the shuffle."""
    rows = entries if partitions is None else entries.where(F.col("partition").isin(*partitions))
    names = entries.columns
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("r")).select("r.*").select(*names)


def drop_partitions(current: DataFrame, partitions) -> DataFrame:
    return current.where(~F.col("partition").isin(*partitions))


def restore_partitions(current: DataFrame, restored: DataFrame, partitions) -> DataFrame:
    """``current`` without the partitions, then the restored entries of these."""
    return drop_partitions(current, partitions).unionByName(restored.where(F.col("partition").isin(*partitions)))


def encode(entries: DataFrame, *kept: str) -> DataFrame:
    """(key, value) from product, partition, last_offset and the state columns, with the ``kept`` columns before them."""
    state = F.struct("count", "mean", "m2", "min", "max", F.unix_millis("last_updated").alias("lastUpdated"))
    return entries.select(*kept, F.col("product").cast("binary").alias("key"), F.to_json(F.struct(F.lit(1).alias("v"), "product", "partition", F.col("last_offset").cast("string").alias("lastOffset"), state.alias("state"))).cast("binary").alias("value"))


def decode(rows: DataFrame) -> DataFrame:
    """rows with entry, the parsed value, and valid. Null values are skipped, they delete nothing; bad ones are invalid and fail nothing."""
    e = F.from_json(F.make_valid_utf8(F.col("value").cast("string")), STATE, {"mode": "PERMISSIVE"})
    rows = rows.where("value is not null").withColumn("entry", e)
    finite = lambda c: f"entry.state.{c} is not null and not isnan(entry.state.{c}) and abs(entry.state.{c}) < double('infinity')"
    test = " and ".join(["entry.v = 1", "entry.product != ''", "entry.partition >= 0", "try_cast(entry.lastOffset as bigint) is not null", "entry.state.count > 0", "entry.state.m2 >= 0", "entry.state.lastUpdated >= 0", *map(finite, ("mean", "m2", "min", "max"))])
    return rows.withColumn("valid", F.coalesce(F.expr(test), F.lit(False)))


def entries(rows: DataFrame) -> DataFrame:
    """product, partition, last_offset and the state columns of decoded, valid changelog rows, with the place of each in the log."""
    e = "entry."
    state = [F.col(f"{e}state.{c}").alias(c) for c in ("count", "mean", "m2", "min", "max")]
    return rows.where("valid").select(F.col(f"{e}product").alias("product"), F.col(f"{e}partition").alias("partition"), F.col(f"{e}lastOffset").cast("long").alias("last_offset"), *state, F.timestamp_millis(f"{e}state.lastUpdated").alias("last_updated"), F.col("timestamp").alias("log_timestamp"), F.col("partition").alias("log_partition"), F.col("offset").alias("log_offset"))


def restore(log: DataFrame, partitions=None) -> DataFrame:
    """The state of each product after a scan of the changelog (log records): bad and null values are skipped, entries of other ``partitions`` go first, then the one with the last offset stands, whatever its time. A product's records share a partition of the log."""
    return latest(entries(decode(log)), "product", ["log_partition", "log_offset"], partitions)


def skipped(log: DataFrame) -> DataFrame:
    """One row: how many values of the changelog are null (empty) and how many do not decode (bad)."""
    bad = decode(log).where("not valid").agg(F.count("*").alias("bad"))
    return log.agg(F.count(F.when(F.col("value").isNull(), 1)).alias("empty")).join(F.broadcast(bad))  # both are one row


def compact(log: DataFrame) -> DataFrame:
    """The record of each key with the last offset, as a compacted topic keeps them; records without key stay."""
    names = log.columns
    keyed = log.where("key is not null").groupBy("key").agg(F.max_by(F.struct(*names), F.struct("partition", "offset")).alias("r")).select("r.*")
    return keyed.select(*names).unionByName(log.where("key is null"))


def dropped_count(current: DataFrame, partitions) -> DataFrame:
    """One row: how many entries ``drop_partitions`` takes away."""
    return current.agg(F.count(F.when(F.col("partition").isin(*partitions), 1)).alias("dropped"))
