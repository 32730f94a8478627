"""The decode job: framed log values to typed orders, or to the error that a router can act on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.frame import ORDER, decode_orders, encode_order, schema_id
from tallyflow.operators.routing import violations


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df``, hinted for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def decode_job(log: DataFrame, schemas: DataFrame, validate: bool = True, value: str = "value") -> DataFrame:
    """log with schema_id, order_id, product, price, error_kind, error_reason and error_message; the first check that fails decides.

    In this order: a null value, a bad frame, a schema id that ``schemas`` (schema_id and, where there is such a column,
    schema_json) does not hold, bytes that do not decode (all deserialization or unknown-schema-id), and, unless ``validate`` is
    off, the order rules (validation). Records are read with their writer's schema and resolved to an order. The error columns
    are null for a good order; the order's are null unless it is one, or decodes and validation is off.
    """
    text = F.col("schema_json") if "schema_json" in schemas.columns else F.lit(None).cast("string")
    known = schemas.groupBy(F.col("schema_id").cast("int").alias("__id")).agg(F.coalesce(F.max(text), F.lit(ORDER)).alias("__writer"))
    framed = log.withColumn("__id", schema_id(F.col(value))).join(small(known), "__id", "left")
    rows = decode_orders(framed, value, F.col("__writer")).withColumn("__known", F.col("__writer"))
    number, frame = F.col("schema_id").cast("string"), F.col("error")
    broken = violations(F.col("order_id"), F.col("product"), F.col("price")) if validate else F.lit("")
    found = lambda reason, message: F.struct(F.lit(reason).alias("reason"), message.alias("message"))
    problem = (
        F.when(F.col(value).isNull(), found("deserialization", F.lit("record value is null")))
        .when(F.col("schema_id").isNull(), found("deserialization", frame))
        .when(F.col("__known").isNull(), found("unknown-schema-id", F.concat(F.lit("no schema has id "), number)))
        .when(frame.isNotNull(), found("deserialization", F.concat(F.lit("decode failed for schema id "), number, F.lit(": "), frame)))
        .when(broken != "", found("validation", broken))
    )
    rows = rows.withColumn("__p", problem)
    order = {c: F.when(F.col("__p").isNull(), F.col(c)) for c in ("order_id", "product", "price")}
    kind = F.when(F.col("__p").isNotNull(), "permanent")
    return rows.select(*log.columns, "schema_id", *[x.alias(c) for c, x in order.items()], kind.alias("error_kind"), F.col("__p.reason").alias("error_reason"), F.col("__p.message").alias("error_message"))


def encode_job(orders: DataFrame, schema_id: int, order_id: str = "order_id", product: str = "product", price: str = "price") -> DataFrame:
    """orders with key (the product) and value (the framed record)."""
    return orders.withColumns({"key": F.col(product).cast("binary"), "value": encode_order(F.lit(schema_id), F.col(order_id), F.col(product), F.col(price))})
