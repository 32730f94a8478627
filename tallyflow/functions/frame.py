"""Framed Avro orders: one magic byte, a 32-bit schema id, then the record. Frames are built-in expressions, records an Arrow kernel."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.avro import decode_avro, encode_avro

HEADER = 5


def bound(value: Column, use) -> Column:
    """``use`` of ``value``, worked out once however often ``use`` names it: lambdas keep Spark from writing the value out at each place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _number(data: Column, start, length: int) -> Column:
    return F.conv(F.hex(F.substring(data, start, length)), 16, 10).cast("long")


def frame_error(value: Column) -> Column:
    """Why the bytes are no frame; null for a frame. Null bytes have no payload at all."""
    size = F.octet_length(value)
    return (
        F.when(value.isNull(), "payload is null")
        .when(size < HEADER, F.format_string("payload is %d bytes; Confluent framing requires at least 5", size))
        .when(F.substring(value, 1, 1) != F.unhex(F.lit("00")), F.concat(F.lit("expected magic byte 0x00, found 0x"), F.lower(F.hex(F.substring(value, 1, 1)))))
    )


def schema_id(value: Column) -> Column:
    """The frame's signed 32-bit schema id; null where there is no frame."""
    raw = _number(value, 2, 4)
    return F.when(frame_error(value).isNull(), F.when(raw >= 1 << 31, raw - (1 << 32)).otherwise(raw).cast("int"))


def payload(value: Column) -> Column:
    return F.when(frame_error(value).isNull(), F.substring(value, HEADER + 1, 1 << 30))


def build_frame(identifier: Column, body: Column) -> Column:
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.right(F.lpad(F.hex(identifier.cast("long")), 16, "0"), F.lit(8))), body)


#: The record of an order.
ORDER = json.dumps({"type": "record", "name": "Order", "fields": [{"name": "orderId", "type": "string"}, {"name": "product", "type": "string"}, {"name": "price", "type": "float"}]})


def encode_order(identifier: Column, order_id: Column, product: Column, price: Column) -> Column:
    """The framed record of an order; null where a field is."""
    return build_frame(identifier, encode_avro(F.struct(order_id.alias("orderId"), product.alias("product"), price.cast("float").alias("price")), ORDER))


def decode_orders(df: DataFrame, value: str = "value", writer: Column | None = None) -> DataFrame:
    """df with schema_id, order_id, product, price and error from framed records of orders; ``writer``: the schema (JSON) that each was written with, the order's own if none is given.

    error: no frame, or the bytes end early, go on after the record, or hold a bad length, or the writer's schema does not fit; the fields are null then.
    """
    v = F.col(value)
    rows = df.withColumns({"schema_id": schema_id(v), "__frame": frame_error(v), "__d": decode_avro(payload(v), F.lit(ORDER) if writer is None else writer, ORDER)})
    record = F.col("__d.record")
    fields = {"error": F.coalesce("__frame", "__d.error"), "order_id": record["orderId"], "product": record["product"], "price": record["price"]}
    return rows.withColumns(fields).drop("__frame", "__d")
