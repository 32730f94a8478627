"""Validation, error classes, the outcome of each record, the retry ladder and the delay gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The marker product of transient failures; connection errors and statuses that pass by themselves.
MARKER = "__TRANSIENT_FAIL__"
TRANSIENT_CODES = ("ECONNRESET", "ECONNREFUSED", "ECONNABORTED", "ETIMEDOUT", "EPIPE", "EAI_AGAIN", "ENOTFOUND", "EHOSTUNREACH", "ENETUNREACH", "UND_ERR_CONNECT_TIMEOUT", "UND_ERR_HEADERS_TIMEOUT", "UND_ERR_SOCKET")
TRANSIENT_STATUSES = (408, 425, 429, 500, 502, 503, 504)
#: The messages of the order rules.
RULES = {"orderId": "orderId must not be empty", "product": "product must not be empty", "finite": "price must be a finite number", "negative": "price must not be negative"}
OUTCOMES = ("processed", "retried", "dead-lettered", "forwarded")


def violations(order_id: Column, product: Column, price: Column) -> Column:
    """All broken rules of an order as "path: message", joined by "; "; empty for a valid one."""
    p = price.cast("double")
    infinite = p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))
    found = F.array(
        F.when(F.coalesce(order_id, F.lit("")) == "", f"orderId: {RULES['orderId']}"),
        F.when(F.coalesce(product, F.lit("")) == "", f"product: {RULES['product']}"),
        F.when(infinite, f"price: {RULES['finite']}"),
        F.when(p.isNotNull() & ~F.isnan(p) & (p < 0), f"price: {RULES['negative']}"),
    )
    return F.array_join(F.array_compact(found), "; ")


def is_order(order_id: Column, product: Column, price: Column) -> Column:
    """Whether an order breaks no rule."""
    return violations(order_id, product, price) == ""


def marker_fails(product: Column, delivery: Column, succeed_after: int, marker: str = MARKER) -> Column:
    """Whether a record simulates an outage: the marker product fails until delivery ``succeed_after``."""
    return F.coalesce((product == marker) & (delivery < succeed_after), F.lit(False))


def classify(kind: Column, reason: Column, code: Column, status: Column, status_code: Column, retriable: Column, message: Column) -> Column:
    """Struct (kind, reason, message): the first rule that speaks decides; what none knows is permanent."""
    text, http = F.coalesce(message, F.lit("")), F.coalesce(status, status_code)
    made = lambda k, r, m: F.struct(F.lit(k).alias("kind"), F.lit(r).cast("string").alias("reason"), m.alias("message"))
    return (
        F.when(kind.isNotNull(), F.struct(kind.alias("kind"), reason.alias("reason"), text.alias("message")))
        .when(code.isin(*TRANSIENT_CODES), made("transient", None, F.concat(code, F.lit(": "), text)))
        .when(http.isin(*TRANSIENT_STATUSES), made("transient", None, F.concat(F.lit("HTTP "), http.cast("string"), F.lit(": "), text)))
        .when((http >= 400) & (http < 500), made("permanent", "unclassified", F.concat(F.lit("HTTP "), http.cast("string"), F.lit(": "), text)))
        .when(retriable, made("transient", None, F.concat(F.lit("retriable client error: "), text)))
        .when(text.rlike(r"(?i)\btime(d )?out\b"), made("transient", None, F.concat(F.lit("timeout: "), text)))
        .otherwise(made("permanent", "unclassified", text))
    )


def classify_registry(status: Column) -> Column:
    """Struct (kind, reason) of a schema registry's answer."""
    made = lambda k, r: F.struct(F.lit(k).alias("kind"), F.lit(r).cast("string").alias("reason"))
    return F.when(status.isin(409, 422), made("permanent", "schema-incompatible")).when(status == 404, made("permanent", "unknown-schema-id")).otherwise(made("transient", None))


def route(records: DataFrame, tiers: DataFrame) -> DataFrame:
    """records (attempt, error_kind: null without an error) with outcome, delivery, next_attempt, tier, delay_ms and error_type.

    A permanent error is a dead letter at once; a transient one goes to the tier after its attempt, or, past the last tier, to
    the dead letters. The tiers are three rows.
    """
    steps = F.broadcast(tiers.select(F.col("attempt").alias("next_attempt"), F.col("label").alias("tier"), "delay_ms"))
    rows = records.withColumn("delivery", F.col("attempt") + 1).withColumn("next_attempt", (F.col("attempt") + 1).cast("int")).join(steps, "next_attempt", "left")
    transient, permanent = F.col("error_kind") == "transient", F.col("error_kind") == "permanent"
    retried = transient & F.col("tier").isNotNull()
    outcome = F.when(permanent, "dead-lettered").when(retried, "retried").when(transient, "dead-lettered").otherwise("processed")
    kind = F.when(permanent, "permanent").when(transient & F.col("tier").isNull(), "transient-exhausted")
    return rows.withColumn("outcome", outcome).withColumn("error_type", kind).withColumn("tier", F.when(retried, F.col("tier"))).withColumn("delay_ms", F.when(retried, F.col("delay_ms")))


def tally(outcomes: DataFrame) -> DataFrame:
    """Rows of each of the four outcomes, zeros included."""
    domain = outcomes.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(f"('{o}')" for o in OUTCOMES) + " AS t(outcome)")
    return domain.join(outcomes.groupBy("outcome").agg(F.count("*").alias("n")), "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"))


def due(records: DataFrame, now_ms, partition: list[str], order: str = "offset", not_before: str = "not_before", chunk: int = 100_000) -> DataFrame:
    """records with due: whether the record and all before it in its partition may go on; a missing time is due.

    Partitions are cut into ranges of ``chunk`` offsets: running maxima within a range, and those of the ranges before.
    """
    time = F.coalesce(not_before, F.lit(0)).cast("long")
    rows = records.withColumn("__range", F.floor(F.col(order) / chunk))
    earlier = Window.partitionBy(*partition).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*partition, "__range").agg(F.max(time).alias("__max")).withColumn("__max", F.max("__max").over(earlier))
    w = Window.partitionBy(*partition, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__own", F.max(time).over(w)).join(before, [*partition, "__range"])
    return rows.select(*records.columns, (F.greatest("__own", "__max") <= now_ms).alias("due"))


def jittered_delay(attempt: Column, base_ms: int, cap_ms: int, draw: Column) -> Column:
    return F.floor(draw * F.least(F.lit(float(cap_ms)), base_ms * F.pow(F.lit(2.0), attempt - 1)))


def conform(df: DataFrame, target: dict[str, str], defaults: dict) -> DataFrame:
    """df with exactly the target's columns: unknown ones go, missing ones take their default; a missing one without default or another type is an error."""
    types = dict(df.dtypes)
    out = []
    for name, kind in target.items():
        if name in types:
            if types[name] != kind:
                raise ValueError(f"{name}: {types[name]} is not {kind}")
            out.append(F.col(name))
        elif name in defaults:
            out.append(F.lit(defaults[name]).cast(kind).alias(name))
        else:
            raise ValueError(f"{name}: missing without default")
    return df.select(*out)
