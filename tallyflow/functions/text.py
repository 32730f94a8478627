"""Text and time expressions: lists, clipping, ISO times, ages, error descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def split_list(text: Column, separator: str = ",") -> Column:
    """The parts of a list without blanks around them; empty parts go."""
    return F.filter(F.transform(F.split(text, separator), lambda x: F.trim(x)), lambda x: x != "")


def clip(text: Column, most: int) -> Column:
    """text within ``most`` characters, the last one an ellipsis where it was longer."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, max(0, most - 1)), F.lit("…"))).otherwise(text)


def pad(text: Column, width: int, right: bool = False) -> Column:
    """text filled up with blanks to ``width``; longer text stays whole."""
    padded = F.lpad(text, width, " ") if right else F.rpad(text, width, " ")
    return F.when(F.length(text) < width, padded).otherwise(text)


def to_iso(millis: Column) -> Column:
    """Epoch milliseconds as ISO text in UTC; the session's time zone must be UTC."""
    return F.date_format(F.timestamp_millis(millis), ISO)


def from_iso(text: Column) -> Column:
    """Epoch milliseconds of ISO text; null where it is none."""
    return F.unix_millis(F.try_to_timestamp(text))


def short_iso(text: Column) -> Column:
    """ISO text to the second, with a blank between day and time."""
    return F.substring(F.replace(text, F.lit("T"), F.lit(" ")), 1, 19)


def end_to_end_seconds(now_ms: Column, original_ms: Column, at_ms: Column) -> Column:
    """Seconds since a record first arrived, none below 0."""
    return F.greatest(F.lit(0), now_ms - F.coalesce(original_ms, at_ms)) / 1000


def relative_age(seconds: Column, at: Column) -> Column:
    """How long ago in words, for an hour at most; then the time of day of ``at``."""
    n = F.floor(seconds + 0.5).cast("long")
    return F.when(n < 5, "just now").when(n < 60, F.concat(n.cast("string"), F.lit(" s ago"))).when(n < 3600, F.concat(F.floor(n / 60 + 0.5).cast("long").cast("string"), F.lit(" min ago"))).otherwise(F.date_format(at, "HH:mm:ss"))


def format_order(order_id: Column, product: Column, price: Column) -> Column:
    """id, product and the price with two decimals."""
    return F.format_string("%s %s %.2f", order_id, product, price.cast("double"))


def describe_error(message: Column, thrown: Column) -> Column:
    """The message, else the thrown value as JSON, so that there is text in any case."""
    return F.coalesce(message, F.to_json(thrown), F.lit("undefined"))
