"""A user's handler over batches of records: errors of single records, tried again within a budget, as columns."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyflow.operators.routing import TRANSIENT_CODES, TRANSIENT_STATUSES


class HandlerError(Exception):
    """A record's error that says what it is: ``kind`` transient or permanent, and the reason of a permanent one."""

    def __init__(self, kind: str, message: str, reason: str | None = None):
        super().__init__(message)
        self.kind, self.reason = kind, reason


def transient(message: str) -> HandlerError:
    return HandlerError("transient", message)


def permanent(message: str, reason: str = "unclassified") -> HandlerError:
    return HandlerError("permanent", message, reason)


def classified(error: BaseException) -> tuple[str, str | None, str]:
    """(kind, reason, message) of an error, by the rules of ``routing.classify``: attributes code, status or status_code and retriable, then the text."""
    text = str(error)
    if isinstance(error, HandlerError):
        return error.kind, error.reason, text
    code, status = getattr(error, "code", None), getattr(error, "status", None)
    status = getattr(error, "status_code", None) if status is None else status
    if code in TRANSIENT_CODES:
        return "transient", None, f"{code}: {text}"
    if status in TRANSIENT_STATUSES:
        return "transient", None, f"HTTP {status}: {text}"
    if isinstance(status, int) and 400 <= status < 500:
        return "permanent", "unclassified", f"HTTP {status}: {text}"
    if getattr(error, "retriable", False):
        return "transient", None, f"retriable client error: {text}"
    if re.search(r"\btime(d )?out\b", text, re.I):
        return "transient", None, f"timeout: {text}"
    return "permanent", "unclassified", text


def handle(records: DataFrame, handler: Callable, attempts: int = 3, budget_ms: int = 2000, base_ms: int = 100, cap_ms: int = 800, at_once: int = 1000, draw: Callable[[], float] = random.random, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """records with error_kind, error_reason, error_message (null where the handler was content), tries and elapsed_ms.

    ``handler(batch, attempt)`` gets up to ``at_once`` records as a pandas DataFrame and the number of the try, from 1. It returns
    nothing, or for each record None or its error; a column ``delivery`` of the records tells which delivery it is. What it
    raises counts for one record: if there are several in the call, its halves are handled by themselves, until a bad record is alone,
    has its own outcome, and the others are processed. (Those may then be handled again, as any record may after a restart: each
    at most once for each halving, and a bad record costs about two calls for each.)

    Transient errors are tried again, the records that have them alone, after a jittered delay that doubles up to a cap, until
    ``attempts`` calls are made or the next delay would pass ``budget_ms``. Permanent errors are not. The tries of a call share
    one delay, so a batch waits no longer than its worst record. Runs inside tasks, by Arrow batches.
    """
    more = [T.StructField(n, t) for n, t in (("error_kind", T.StringType()), ("error_reason", T.StringType()), ("error_message", T.StringType()), ("tries", T.IntegerType()), ("elapsed_ms", T.LongType()))]
    schema = T.StructType([*records.schema.fields, *more])

    def called(batch, attempt: int) -> list:
        try:
            found = handler(batch.reset_index(drop=True), attempt)
        except Exception as e:  # noqa: BLE001 - a handler may raise anything; the record gets it as its outcome
            if len(batch) == 1:
                return [e]
            half = len(batch) // 2
            return called(batch.iloc[:half], attempt) + called(batch.iloc[half:], attempt)
        return [None] * len(batch) if found is None else [x if isinstance(x, BaseException) else None for x in found]

    def outcomes(batch) -> list[tuple]:
        began, out, open_, attempt = time.monotonic(), [None] * len(batch), list(range(len(batch))), 1
        while open_:
            errors = called(batch.iloc[open_], attempt)
            spent = int((time.monotonic() - began) * 1000)
            again = []
            for i, e in zip(open_, errors, strict=True):
                kind, reason, message = classified(e) if e is not None else (None, None, None)
                out[i] = (kind, reason, message, attempt, spent)
                if kind == "transient":
                    again.append(i)
            delay = int(draw() * min(cap_ms, base_ms * 2 ** (attempt - 1)))
            if attempt >= attempts or spent + delay > budget_ms:
                break
            if again:
                sleep(delay / 1000)
            open_, attempt = again, attempt + 1
        return out

    def run(batches):
        import pandas as pd

        for df in batches:
            for low in range(0, len(df), at_once):
                part = df.iloc[low : low + at_once]
                found = pd.DataFrame(outcomes(part), columns=[f.name for f in more], index=part.index)
                yield pd.concat([part, found.astype({"tries": "int32", "elapsed_ms": "int64"})], axis=1)

    return records.mapInPandas(run, schema)
