"""Schema, cache and retry around a pluggable extractor that turns review texts into issues."""

from __future__ import annotations

import os
import random
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.functions.text import DAILY_MARKS, RATE_MARKS, RETRY_CODES, RETRY_MARKS
from themeloom.operators.schema import Declaration, Field
from themeloom.operators.themes import AREAS

#: The fields of an issue and the labels they may have.
DECLARATION = Declaration(
    "issues",
    (
        Field("theme"),
        Field("severity", ("low", "medium", "high")),
        Field("sentiment", ("positive", "neutral", "negative")),
        Field("feature_area", tuple(AREAS)),
        Field("segment_hint"),
    ),
    most=4,
)
MOST_ISSUES = DECLARATION.most
ISSUES = DECLARATION.ddl()
PROMPT = "List the product issues that the review reports, as the schema says."

Backend = Callable[[str], list[dict]]
_BACKENDS: dict[str, tuple[Callable[[], Backend], str | None]] = {}


def register(name: str, make: Callable[[], Backend], secret: str | None = None) -> None:
    """A backend by name; make() builds it in the worker, secret is the environment variable it needs."""
    _BACKENDS[name] = (make, secret)


def backend(name: str) -> Callable[[], Backend]:
    if name not in _BACKENDS:
        raise ValueError(f"unknown provider {name!r}; known: {sorted(_BACKENDS)}")
    make, secret = _BACKENDS[name]
    if secret and not os.environ.get(secret):
        raise RuntimeError(f"{name} is not configured: {secret} is not set")
    return make


def json_schema() -> dict:
    """The tool schema of an issue list; every field is required."""
    return DECLARATION.json_schema()


def flat_tool(name: str) -> dict:
    """The tool as a flat record of name, description and input schema."""
    return {"name": name, "description": PROMPT, "input_schema": json_schema()}


def nested_tool(name: str) -> dict:
    """The tool as a function record inside a typed one."""
    return {"type": "function", "function": {"name": name, "description": PROMPT, "parameters": json_schema()}}


def outcome(error: Exception) -> str:
    """What an error means: `daily_cap` (stop), `rate_limit` or `server` (try again), or `failed`."""
    said, code = str(error).lower(), getattr(error, "status_code", None)
    if any(mark in said for mark in DAILY_MARKS):
        return "daily_cap"
    if code not in RETRY_CODES and not any(mark in said for mark in RETRY_MARKS):
        return "failed"
    return "rate_limit" if code == 429 or any(mark in said for mark in RATE_MARKS) else "server"


def waits(retries: int, base: float, cap: float) -> Iterator[float]:
    """The jittered pause before each further attempt."""
    for k in range(retries):
        yield min(cap, base * 2**k) * random.uniform(0.5, 1.5)


def with_retry(
    call: Callable[[], list[dict]],
    retries: int = 5,
    base: float = 1.0,
    cap: float = 30.0,
    wait: Callable[[float], None] = time.sleep,
    stopped: Callable[[], bool] = lambda: False,
) -> tuple[list[dict] | None, str, list[dict]]:
    """(issues, status, attempts): transient errors are tried again, an exhausted daily allowance is not.

    attempts has a record of each call: at (seconds), attempt, kind (ok, rate_limit, server, failed, daily_cap), said, and
    the seconds waited before it. Before each call `stopped` is asked; if it says so there is no further call.
    """
    pauses, log, waited = waits(retries, base, cap), [], 0.0
    while not stopped():
        found, kind, said, at = None, "ok", None, time.time()
        try:
            found = call()
        except Exception as error:
            kind, said = outcome(error), str(error)
        log.append({"at": at, "attempt": len(log) + 1, "kind": kind, "said": said, "waited": waited})
        if kind in ("ok", "failed", "daily_cap"):
            return found, kind, log
        waited = next(pauses, None)
        if waited is None:
            return None, "failed", log
        wait(waited)
    return None, "daily_cap", log


def with_cache(reviews: DataFrame, cache: DataFrame, found: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(review_id, issues, status, cached): cached issues where there are some, else what `found` gives for the rest.

    reviews(review_id, text), cache(review_id, issues) of one cache key; found(reviews) gives (review_id, issues) of those
    with issues, the others have none. Issues are capped. A backend that is called, fails and has a daily allowance is run
    by operators/runs.py.
    """
    capped = F.slice("issues", 1, MOST_ISSUES).alias("issues")
    hits = reviews.join(cache, "review_id").select("review_id", capped, F.lit("ok").alias("status"), F.lit(True).alias("cached"))
    todo = reviews.join(cache, "review_id", "left_anti").select("review_id", "text")
    fresh = todo.join(found(todo), "review_id", "left").withColumn("issues", F.coalesce("issues", F.array().cast(ISSUES)))
    return hits.unionByName(fresh.select("review_id", capped, F.lit("ok").alias("status"), F.lit(False).alias("cached")))
