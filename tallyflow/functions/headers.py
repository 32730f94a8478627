"""Record headers: arrays of (key, value bytes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_TYPE = "array<struct<key:string,value:binary>>"
#: Header names.
CORRELATION_ID, APP_VERSION = "x-correlation-id", "x-app-version"
RETRY_ATTEMPT, RETRY_NOT_BEFORE = "x-attempt-count", "x-retry-not-before"
FIRST_FAILED_AT, LAST_FAILED_AT = "x-first-failed-at", "x-last-failed-at"
ORIGINAL_TOPIC, ORIGINAL_PARTITION = "x-original-topic", "x-original-partition"
ORIGINAL_OFFSET, ORIGINAL_TIMESTAMP = "x-original-offset", "x-original-timestamp"


def encode_headers(values: dict[str, Column]) -> Column:
    """Headers of the columns that are not null; numbers as decimal text, zero included."""
    one = lambda name, c: F.struct(F.lit(name).alias("key"), c.cast("string").cast("binary").alias("value"))
    return F.filter(F.array(*[one(n, c) for n, c in values.items()]), lambda h: h["value"].isNotNull()).cast(HEADER_TYPE)


def producer_headers(version: str) -> Column:
    """The headers of a produced record: a new correlation id and the version."""
    return encode_headers({CORRELATION_ID: F.uuid(), APP_VERSION: F.lit(version)})


def merge_headers(old: Column, new: Column) -> Column:
    """``old`` without null values and without the names in ``new``, then ``new``."""
    names = F.transform(new, lambda h: h["key"])
    kept = F.filter(F.coalesce(old, F.array().cast(HEADER_TYPE)), lambda h: h["value"].isNotNull() & ~F.array_contains(names, h["key"]))
    return F.concat(kept, new)


def strip_headers(headers: Column, names) -> Column:
    return F.filter(F.coalesce(headers, F.array().cast(HEADER_TYPE)), lambda h: ~h["key"].isin(*names))


def read_header(headers: Column, name: str) -> Column:
    """The text of the only header of that name; null if there is none or more than one."""
    found = F.filter(headers, lambda h: h["key"] == name)
    return F.when(F.size(found) == 1, F.make_valid_utf8(F.get(found, F.lit(0))["value"].cast("string")))


def leading_int(text: Column) -> Column:
    """The integer that a text starts with, after blanks and with a sign; null without one."""
    return F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint")


def read_int_header(headers: Column, name: str) -> Column:
    return leading_int(read_header(headers, name))


def header_names(headers: Column) -> Column:
    return F.array_sort(F.transform(headers, lambda h: h["key"]))


def retry_metadata(headers: Column) -> dict[str, Column]:
    """The eight retry columns; attempt is 0 without a header."""
    return {
        "attempt": F.coalesce(read_int_header(headers, RETRY_ATTEMPT), F.lit(0)),
        "not_before": read_int_header(headers, RETRY_NOT_BEFORE),
        "first_failed_at": read_header(headers, FIRST_FAILED_AT),
        "last_failed_at": read_header(headers, LAST_FAILED_AT),
        "original_topic": read_header(headers, ORIGINAL_TOPIC),
        "original_partition": read_int_header(headers, ORIGINAL_PARTITION),
        "original_offset": read_header(headers, ORIGINAL_OFFSET),
        "original_timestamp": read_int_header(headers, ORIGINAL_TIMESTAMP),
    }
