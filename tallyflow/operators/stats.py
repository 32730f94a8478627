"""Running statistics by key: folds, merges, snapshots and histories. Columns are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.text import to_iso


def _figures(value, at):
    v = F.col(value).cast("double")
    n = F.count(v)
    return [n.alias("count"), F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias("m2"), F.min(v).alias("min"), F.max(v).alias("max"), F.var_samp(v).alias("variance"), F.stddev_samp(v).alias("stddev"), F.max(at).alias("last_updated")]


def fold(df: DataFrame, key: str, value: str, at: str) -> DataFrame:
    """count, mean, m2, min, max, sample variance and deviation (null below two values) and the latest time by key. Partial aggregates merge before the shuffle, so a hot key costs a row a task."""
    return df.groupBy(key).agg(*_figures(value, at))


def overall(df: DataFrame, value: str, at: str) -> DataFrame:
    """One row over all keys, also for no rows: count 0, mean 0, the rest null."""
    return df.agg(*_figures(value, at))


def snapshot(df: DataFrame, key: str, value: str, at: str, partitions=()) -> DataFrame:
    """Keys in locale order, then the row over all of them: its ``overall`` is true and its key null, where the row of records without key has false. ``partitions``: those owned, told in order in the last row, whether they hold keys or not. One scan: the last row is an aggregate of its own only where there are no records."""
    rows = df.groupingSets([[key], []], key).agg(*_figures(value, at), (F.grouping(key) == 1).alias("overall"))
    rows = rows.select(F.col(key).cast("string").alias("key"), "*").drop(key)
    if df.isEmpty():
        rows = overall(df, value, at).select(F.lit(None).cast("string").alias("key"), "*", F.lit(True).alias("overall"))
    owned = F.array(*[F.lit(int(p)) for p in sorted(set(partitions))]).cast("array<int>")
    return rows.withColumn("partitions", F.when(F.col("overall"), owned)).orderBy("overall", F.collate("key", "UNICODE"))


def merge_states(states: DataFrame, key: str | None = None) -> DataFrame:
    """Merge of partial states (count, mean, m2, min, max, last_updated) by key, or of all. Empty states change nothing. Sums of n, n * mean and n * mean**2 give m2 about the merged mean; they are taken about the mean of the key's largest state, which an aggregate finds first, to keep their digits."""
    keys = [key] if key else []
    some = states.where("count > 0")
    centre = some.groupBy(*keys).agg(F.max_by("mean", F.struct("count", "mean")).alias("__c"))
    joined = some.join(centre.withColumnRenamed(key, "__key"), F.col(key).eqNullSafe(F.col("__key"))) if key else some.join(F.broadcast(centre))
    d = F.col("mean") - F.col("__c")
    n, shift = F.sum("count"), F.sum(F.col("count") * d) / F.sum("count")
    m2 = F.sum("m2") + F.sum(F.col("count") * d * d) - n * shift * shift
    return joined.groupBy(*keys).agg(n.alias("count"), (F.max("__c") + shift).alias("mean"), F.greatest(m2, F.lit(0.0)).alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"), F.max("last_updated").alias("last_updated"))


def history(df: DataFrame, key: str, value: str, at: str, order: list[str], chunk: Column | None = None) -> DataFrame:
    """The state after each record of its key, in the given order.

    ``chunk``, a column that never falls along the order, cuts a key's records into parts: states run within a part and go on
    from the sums of the parts before, so that a hot key is spread over tasks. Sums are taken about the key's mean, which keeps
    their digits.
    """
    v = F.col("__v")
    rows = df.withColumns({"__v": F.col(value).cast("double"), "__chunk": F.lit(0) if chunk is None else chunk})
    rows = rows.join(rows.groupBy(F.col(key).alias("__key")).agg(F.avg("__v").alias("__mean")), F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
    d = v - F.col("__mean")
    figures = {"n": F.count(v), "s": F.sum(d), "q": F.sum(d * d), "lo": F.min(v), "hi": F.max(v), "t": F.max(at)}
    parts = rows.groupBy(F.col(key).alias("__key"), F.col("__chunk").alias("__c")).agg(*[x.alias(f"__{c}") for c, x in figures.items()])
    earlier = Window.partitionBy("__key").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    fold_of = {"n": F.sum, "s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max, "t": F.max}
    ahead = parts.select("__key", "__c", *[f(f"__{c}").over(earlier).alias(f"__{c}") for c, f in fold_of.items()])
    w = Window.partitionBy(key, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = rows.select(*df.columns, "__mean", "__chunk", *[x.over(w).alias(f"__w{c}") for c, x in figures.items()])
    joined = within.join(ahead, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__chunk") == F.col("__c")))
    both = lambda c: F.coalesce(F.col(f"__{c}"), F.lit(0)) + F.coalesce(F.col(f"__w{c}"), F.lit(0))
    n, s, q = both("n"), both("s"), both("q")
    mean = F.when(n > 0, F.col("__mean") + s / n)
    variance = F.when(n > 1, F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1))
    return joined.select(*df.columns, n.cast("long").alias("count"), mean.alias("mean"), variance.alias("variance"), F.least("__lo", "__wlo").alias("min"), F.greatest("__hi", "__whi").alias("max"), F.greatest("__t", "__wt").alias("last_updated"))


def last_offsets(df: DataFrame, key: str, order: list[str], offset: str = "offset") -> DataFrame:
    """The offset of each key's most recent record."""
    return df.groupBy(key).agg(F.max_by(offset, F.struct(*order)).alias("last_offset"))


def key_count(df: DataFrame, key: str) -> DataFrame:
    """One row: how many keys there are."""
    return df.agg(F.count_distinct(key).alias("keys"))


def lookup(snapshot_rows: DataFrame, name: str, key: str = "key") -> DataFrame:
    """The snapshot row of one key; no row where it is not known."""
    return snapshot_rows.where(F.col(key) == name)


def view(states: DataFrame) -> DataFrame:
    """States (count, mean, m2, min, max, last_updated) as shown: an empty one has mean 0 and nothing else, variances begin at two values, times are ISO text in UTC."""
    some = lambda c: F.when(F.col("count") > 0, F.col(c))
    variance = F.when(F.col("count") > 1, F.col("m2") / (F.col("count") - 1))
    shown = {"mean": F.coalesce(some("mean"), F.lit(0.0)), "min": some("min"), "max": some("max"), "variance": variance, "stddev": F.sqrt(variance), "last_updated": to_iso(F.unix_millis(some("last_updated").cast("timestamp")))}
    return states.withColumns(shown).drop("m2")


def distinct_orders(orders: DataFrame, order_id: str, order: list[str]) -> DataFrame:
    """The first record of each order id."""
    names = orders.columns
    return orders.groupBy(order_id).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("r")).select("r.*").select(*names)
