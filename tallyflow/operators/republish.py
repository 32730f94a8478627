"""What happens to routed records next: retry topics with their headers, the way back to the main topic, in-place retry plans, decode reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.frame import bound, decode_orders, frame_error
from tallyflow.functions.headers import FIRST_FAILED_AT, LAST_FAILED_AT, ORIGINAL_OFFSET, ORIGINAL_PARTITION, ORIGINAL_TIMESTAMP, ORIGINAL_TOPIC, RETRY_ATTEMPT, RETRY_NOT_BEFORE, encode_headers, header_names, merge_headers, retry_metadata
from tallyflow.operators.routing import due, jittered_delay


def retry_headers(headers: Column, source: dict[str, Column], attempt: Column, not_before: Column, failed_at: Column) -> Column:
    """The record's headers with those of its next try. Where it first came from and first failed stays as the first hop wrote it."""
    places = {ORIGINAL_TOPIC: "topic", ORIGINAL_PARTITION: "partition", ORIGINAL_OFFSET: "offset", ORIGINAL_TIMESTAMP: "timestamp"}

    def updated(h: Column) -> Column:
        old = retry_metadata(h)
        origin = {name: F.coalesce(old[f"original_{c}"].cast("string"), source[c].cast("string")) for name, c in places.items()}
        new = {RETRY_ATTEMPT: attempt, RETRY_NOT_BEFORE: not_before, FIRST_FAILED_AT: F.coalesce(old["first_failed_at"], failed_at), LAST_FAILED_AT: failed_at}
        return bound(encode_headers(new | origin), lambda made: merge_headers(h, made))

    return bound(headers, updated)


def escalate(routed: DataFrame, now_ms: Column, failed_at: Column, prefix: str = "orders") -> DataFrame:
    """The retried rows of ``routing.route`` over log records (timestamp in milliseconds as ``timestamp_ms``), as records of their tier's topic; key and value are untouched."""
    rows = routed.where("outcome = 'retried'")
    source = {"topic": F.col("topic"), "partition": F.col("partition"), "offset": F.col("offset"), "timestamp": F.col("timestamp_ms")}
    headers = retry_headers(F.col("headers"), source, F.col("next_attempt"), now_ms + F.col("delay_ms"), failed_at)
    return rows.withColumn("headers", headers).withColumn("topic", F.concat(F.lit(f"{prefix}.retry."), "tier"))


def forward_due(queue: DataFrame, sent: DataFrame, now_ms, topic: str = "orders") -> DataFrame:
    """The records of the retry topics that are due and not in ``sent`` (topic, partition, offset) yet, addressed to the main topic, with retry_topic for where they waited; headers stay. A record waits for those before it in its partition."""
    place = ["topic", "partition", "offset"]
    pending = queue.join(sent.select(*place), place, "left_anti")
    return due(pending, now_ms, ["topic", "partition"]).where("due").drop("due").withColumnsRenamed({"topic": "retry_topic"}).withColumn("topic", F.lit(topic))


def retry_plan(failures: Column, draws: Column, attempts: int = 3, budget_ms: int = 2000, base_ms: int = 100, cap_ms: int = 800) -> Column:
    """Struct (attempts, elapsed_ms, succeeded) of an operation that fails ``failures`` times in a row and waits a jittered delay between tries: it ends with success, after the last attempt, or where the next delay would pass the budget. ``draws``: one number in [0, 1) for each delay."""
    state = lambda n, t, over: F.struct(n.cast("int").alias("n"), t.cast("long").alias("t"), over.alias("over"))

    def step(s: Column, k: Column) -> Column:
        later = s["t"] + jittered_delay(k, base_ms, cap_ms, F.get(draws, (k - 1).cast("int")))
        ends = (k > failures) | (k == attempts) | F.coalesce(later > budget_ms, F.lit(True))
        return F.when(s["over"], s).when(ends, state(k, s["t"], F.lit(True))).otherwise(state(k, later, F.lit(False)))

    end = lambda s: F.struct(s["n"].alias("attempts"), s["t"].alias("elapsed_ms"), (s["n"] > failures).alias("succeeded"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(attempts)), state(F.lit(0), F.lit(0), F.lit(False)), step, end)


def decode_report(letters: DataFrame) -> DataFrame:
    """letters with header_names, frame_error, the first 64 bytes as hex and as printable text, and the order decoded without validation; each part stands when others fail."""
    head = F.substring("value", 1, 64)
    text = F.regexp_replace(F.make_valid_utf8(head.cast("string")), r"[^\x20-\x7e]", ".")
    rows = letters.withColumns({"header_names": header_names(F.col("headers")), "frame_error": frame_error(F.col("value")), "hex": F.lower(F.hex(head)), "preview": text})
    return decode_orders(rows).withColumnRenamed("error", "decode_error")
