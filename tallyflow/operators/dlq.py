"""Dead letters: listing, selection, text caps, replay headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.frame import bound
from tallyflow.functions.headers import APP_VERSION, CORRELATION_ID, encode_headers, merge_headers, read_header, read_int_header, retry_metadata, strip_headers
from tallyflow.functions.text import clip, short_iso, to_iso

#: Headers that describe a failure and go on replay; the replay's own; the mark of a cut text.
FAILURE_HEADERS = ("x-original-topic", "x-original-partition", "x-original-offset", "x-original-timestamp", "x-original-key", "x-error-type", "x-error-class", "x-error-message", "x-error-stack", "x-attempt-count", "x-first-failed-at", "x-last-failed-at", "x-consumer-group", "x-retry-not-before")
REPLAY_OFFSET, REPLAY_AT, REPLAY_COUNT = "x-replayed-from-dlq-offset", "x-replayed-at", "x-replay-count"
CUT = "…[truncated]"


def truncate_utf8(text: Column, most: int) -> Column:
    """text within ``most`` bytes, with a mark where it was cut; no character is split."""
    head = F.make_valid_utf8(F.substring(text.cast("binary"), 1, most - len(CUT.encode())).cast("string"))
    return F.when(F.octet_length(text) > most, F.concat(F.regexp_replace(head, "�+$", ""), F.lit(CUT))).otherwise(text)


def select_letters(letters: DataFrame, offsets=None, everything: bool = False, low: int | None = None, high: int | None = None) -> DataFrame:
    """All, else the given offsets, else the inclusive range, else none; by offset alone."""
    o = F.col("offset")
    if everything:
        return letters
    if offsets is not None:
        return letters.join(offsets, "offset", "left_semi") if isinstance(offsets, DataFrame) else letters.where(o.isin(*offsets))
    if low is None and high is None:
        return letters.where(F.lit(False))
    return letters.where((o >= low if low is not None else F.lit(True)) & (o <= high if high is not None else F.lit(True)))


def newest(letters: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last n in the order; all for n of 0 or less. A sort with limit: each task sends n rows at most."""
    return letters if n <= 0 else letters.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def by_type(letters: DataFrame, kind: str = "error_type") -> DataFrame:
    return letters.groupBy(F.coalesce(kind, F.lit("?")).alias("error_type")).agg(F.count("*").alias("n"))


#: The metadata of a dead letter, by the header that holds it; numbers are read as such.
METADATA = {
    "original_topic": "x-original-topic",
    "original_partition": "x-original-partition",
    "original_offset": "x-original-offset",
    "original_timestamp": "x-original-timestamp",
    "original_key": "x-original-key",
    "error_type": "x-error-type",
    "error_class": "x-error-class",
    "error_message": "x-error-message",
    "error_stack": "x-error-stack",
    "attempt": "x-attempt-count",
    "first_failed_at": "x-first-failed-at",
    "last_failed_at": "x-last-failed-at",
    "consumer_group": "x-consumer-group",
    "correlation_id": CORRELATION_ID,
    "app_version": APP_VERSION,
    "replayed_from_offset": REPLAY_OFFSET,
    "replay_count": REPLAY_COUNT,
}
NUMBERS = ("original_partition", "original_timestamp", "attempt", "replay_count")
ERROR_TYPES = ("permanent", "transient-exhausted")


def metadata(headers: Column) -> Column:
    """Struct of the 17 metadata fields; null where a header is missing, and for an unknown error type."""

    def read(h: Column, field: str, name: str) -> Column:
        value = read_int_header(h, name) if field in NUMBERS else read_header(h, name)
        return (F.when(value.isin(*ERROR_TYPES), value) if field == "error_type" else value).alias(field)

    return bound(headers, lambda h: F.struct(*[read(h, field, name) for field, name in METADATA.items()]))


def list_rows(letters: DataFrame) -> DataFrame:
    """offset, written_at, error_type, error_class, reason, origin, attempt, key, correlation_id and replays of dead letters (log records), with ? or empty text for what is not known."""
    rows = letters.withColumn("__m", metadata(F.col("headers")))
    m = lambda c: F.col(f"__m.{c}")
    or_mark = lambda c: F.coalesce(m(c).cast("string"), F.lit("?"))
    or_empty = lambda *c: F.coalesce(*c, F.lit(""))
    origin = F.when(m("original_topic").isNull(), "?").otherwise(F.concat(m("original_topic"), F.lit("["), or_mark("original_partition"), F.lit("]@"), or_mark("original_offset")))
    return rows.select("partition", "offset", to_iso(F.unix_millis("timestamp")).alias("written_at"), or_mark("error_type").alias("error_type"), or_mark("error_class").alias("error_class"), or_empty(m("error_message")).alias("reason"), origin.alias("origin"), or_mark("attempt").alias("attempt"), or_empty(m("original_key"), F.col("key").cast("string")).alias("key"), or_empty(m("correlation_id")).alias("correlation_id"), or_empty(m("replay_count").cast("string")).alias("replays"))


def shown_rows(rows: DataFrame) -> DataFrame:
    """The listing as a terminal shows it: times to the second, keys and reasons clipped, ids shortened."""
    return rows.withColumns({"written_at": short_iso(F.col("written_at")), "key": clip(F.col("key"), 20), "reason": clip(F.col("reason"), 60), "correlation_id": F.substring("correlation_id", 1, 8)})


def listing(letters: DataFrame, n: int = 0) -> tuple[DataFrame, DataFrame]:
    """The list rows of the newest ``n`` letters (all for 0), and per error type of these: n, with shown and total in each row."""
    shown = list_rows(newest(letters, n, ["partition", "offset"]))
    counts = letters.agg(F.count("*").alias("total"))
    types = by_type(shown)
    sums = types.agg(F.sum("n").alias("shown"))  # both are one row
    return shown, types.join(F.broadcast(sums)).join(F.broadcast(counts))


def letter_records(failed: DataFrame, headers: Column, topic: str = "orders.dlq") -> DataFrame:
    """Failed log records as dead letters: key and value bytes as they came, ``headers`` (``dead_letter_headers``) in place of their own."""
    return failed.withColumn("headers", headers).withColumn("topic", F.lit(topic)).select("topic", "partition", "offset", "timestamp", "key", "value", "headers")


def replay(letters: DataFrame, at: Column, topic: str = "orders") -> tuple[DataFrame, DataFrame]:
    """(records, results) of selected letters: the records to write to ``topic``, with the same key and value bytes, and a row (dlq_offset, key, correlation_id, replay_count, target) for each. A dry run is to write nothing."""
    rows = letters.withColumn("__new", replay_headers(F.col("headers"), F.col("offset"), at))
    records = rows.withColumn("headers", F.col("__new")).withColumn("topic", F.lit(topic)).select("topic", "partition", "offset", "timestamp", "key", "value", "headers")
    results = rows.select(F.col("offset").alias("dlq_offset"), F.col("key").cast("string").alias("key"), read_header(F.col("__new"), CORRELATION_ID).alias("correlation_id"), read_int_header(F.col("__new"), REPLAY_COUNT).alias("replay_count"), F.lit(topic).alias("target"))
    return records, results


def replay_headers(headers: Column, offset: Column, at: Column) -> Column:
    """headers without those of the failure, with where and when the replay came from and its count."""

    def replayed(h: Column) -> Column:
        count = F.coalesce(read_int_header(h, REPLAY_COUNT), F.lit(0)) + 1
        return bound(encode_headers({REPLAY_OFFSET: offset, REPLAY_AT: at, REPLAY_COUNT: count}), lambda new: merge_headers(strip_headers(h, FAILURE_HEADERS), new))

    return bound(headers, replayed)


def dead_letter_headers(headers: Column, source: dict[str, Column], error: dict[str, Column], attempt: Column, failed_at: Column, group: str, version: str) -> Column:
    """The 15 headers of a dead letter, in place of the record's own.

    ``source``: topic, partition, offset, timestamp, key; where the record's retry headers name its first place and failure,
    these stand. ``error``: type, class, reason (null unless permanent), message, stack; message and stack are capped at 1024
    and 2048 bytes. A missing key, correlation id or stack is empty text.
    """
    return bound(headers, lambda h: _forensic(h, source, error, attempt, failed_at, group, version))


def _forensic(headers: Column, source: dict[str, Column], error: dict[str, Column], attempt: Column, failed_at: Column, group: str, version: str) -> Column:
    retry, empty = retry_metadata(headers), F.lit("")
    text = F.coalesce(error["message"], empty)
    message = F.when(error["reason"].isNotNull(), F.concat(error["reason"], F.lit(": "), text)).otherwise(text)
    origin = {f"x-original-{c}": F.coalesce(retry[f"original_{c}"].cast("string"), source[c].cast("string")) for c in ("topic", "partition", "offset", "timestamp")}
    return encode_headers(
        origin
        | {
            "x-original-key": F.coalesce(source["key"].cast("string"), empty),
            "x-error-type": error["type"],
            "x-error-class": error["class"],
            "x-error-message": truncate_utf8(message, 1024),
            "x-error-stack": truncate_utf8(F.coalesce(error["stack"], empty), 2048),
            "x-attempt-count": attempt,
            "x-first-failed-at": F.coalesce(retry["first_failed_at"], failed_at),
            "x-last-failed-at": failed_at,
            "x-consumer-group": F.lit(group),
            CORRELATION_ID: F.coalesce(read_header(headers, CORRELATION_ID), empty),
            APP_VERSION: F.lit(version),
        }
    )
