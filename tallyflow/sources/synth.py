"""Generated orders and injected faults, as column jobs at any scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyflow.functions.frame import encode_order
from tallyflow.operators.routing import MARKER

#: The poison payloads.
POISON_JSON = '{"orderId":"9999","product":"Item1","price":42,"note":"not avro"}'
UNKNOWN_SCHEMA_ID = 999999


def draw(seed: int, *cols) -> Column:
    """A uniform number in [0, 1) that depends on the columns alone, so that reruns and retried tasks agree."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 53)).cast("double") / float(1 << 53)


def synth_orders(spark: SparkSession, n: int, products=("Item1", "Item2", "Item3", "Item4", "Item5"), low: float = 1.0, high: float = 500.0, first_id: int = 1001, seed: int = 1) -> DataFrame:
    """order_id (sequential), product (uniform) and price (uniform, whole cents, float)."""
    ids = spark.range(n).withColumn("order_id", (F.col("id") + first_id).cast("string"))
    choice = F.floor(draw(seed, "id", F.lit("product")) * len(products)).cast("int")
    product = F.element_at(F.array(*map(F.lit, products)), choice + 1)
    price = F.round(low + draw(seed, "id", F.lit("price")) * (high - low), 2).cast("float")
    return ids.select("order_id", product.alias("product"), price.alias("price"))


def inject_faults(orders: DataFrame, transient: float = 0.15, poison: float = 0.05, roll: Column | None = None, seed: int = 2, schema_id: int = 1, buckets: int = 64) -> DataFrame:
    """orders with fault (poison, transient or valid), flavour, sent_product, key and value.

    roll < poison makes poison bytes whose flavours take turns in the order of the ids, roll < poison + transient the marker
    product, else the order stays. The key is the real product. Turns are counted in two steps, by ranges of ids, so that no
    task orders all poison rows.
    """
    if poison + transient > 1:
        raise ValueError("rates sum to more than 1")
    roll = draw(seed, "order_id") if roll is None else roll
    number = F.col("order_id").cast("long")
    rows = orders.withColumn("roll", roll).withColumn("fault", F.when(F.col("roll") < poison, "poison").when(F.col("roll") < poison + transient, "transient").otherwise("valid"))
    rows = rows.withColumn("range", F.floor(number / 10_000))
    poisoned = F.when(F.col("fault") == "poison", 1).otherwise(0)
    before = rows.groupBy("range").agg(F.sum(poisoned).alias("n")).select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    turn = F.sum(poisoned).over(Window.partitionBy("range").orderBy(number, "order_id").rowsBetween(Window.unboundedPreceding, 0)) - 1
    rows = rows.join(before, "range").withColumn("turn", F.pmod(F.col("ahead") + turn, F.lit(3)))
    rows = rows.withColumn("flavour", F.when(F.col("fault") == "poison", F.element_at(F.array(*map(F.lit, ("json", "unknown-schema", "truncated"))), (F.col("turn") + 1).cast("int"))))
    rows = rows.withColumn("sent_product", F.when(F.col("fault") == "transient", MARKER).otherwise(F.col("product")))
    good = encode_order(F.lit(schema_id), F.col("order_id"), F.col("sent_product"), F.col("price"))
    value = F.when(F.col("flavour") == "json", F.lit(POISON_JSON).cast("binary")).when(F.col("flavour") == "unknown-schema", unknown_schema_payload()).when(F.col("flavour") == "truncated", truncated_payload(good)).otherwise(good)
    return rows.select("order_id", "product", "price", "roll", "fault", "flavour", "sent_product", F.col("product").cast("binary").alias("key"), value.alias("value"))


def unknown_schema_payload() -> Column:
    return F.unhex(F.lit(f"00{UNKNOWN_SCHEMA_ID:08X}024100"))


def truncated_payload(value: Column) -> Column:
    """The first eight bytes of a longer value; for a shorter one the frame of an unknown schema."""
    return F.when(F.octet_length(value) > 8, F.substring(value, 1, 8)).otherwise(unknown_schema_payload())
