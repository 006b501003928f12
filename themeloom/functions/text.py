"""Scalar rules of the feed: strip, truthiness, rounding, error classes, hashes. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the white space that str.strip removes, as a character class.
STRIP_CLASS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: HTTP codes worth another try, and message parts that say so.
RETRY_CODES = (408, 425, 429, 500, 502, 503, 504)
RETRY_MARKS = (
    "rate limit", "rate_limit", "rate-limit", "too many requests", "quota", "timeout", "timed out", "connection",
    "temporarily unavailable", "503", "502", "504",
)
#: Message parts of an exhausted daily allowance.
DAILY_MARKS = (
    "per day", "per-day", "tokens per day", "tokens-per-day", "requests per day", "requests-per-day", "daily limit",
    "daily rate limit", "daily quota", "daily token", "reached your daily", "reset-day",
)
#: Message parts of a rate limit.
RATE_MARKS = ("rate limit", "too many requests", "quota")


def strip(text: Column) -> Column:
    """Trim as str.strip does; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{STRIP_CLASS}+|{STRIP_CLASS}+$", "")


def first_truthy(*columns: Column) -> Column:
    """The first neither null nor empty string, else the empty one."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def iso8601(ts: Column) -> Column:
    """ISO form in UTC; microseconds only where there are some."""
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.date_format(ts, "SSSSSS") != "000000", F.date_format(ts, ".SSSSSS")).otherwise(""), F.lit("+00:00"),
    )


def snippet(text: Column, n: int = 60) -> Column:
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.when(F.length(flat) > n, F.concat(F.substring(flat, 1, n), F.lit("..."))).otherwise(flat)


def bar(percent: Column) -> Column:
    """One mark for two percent, half to even."""
    return F.repeat(F.lit("#"), F.bround(percent / 2, 0).cast("int"))


def percent(n: Column, of: Column, digits: int = 0) -> Column:
    """Half-even percent; null where the denominator is 0."""
    return F.bround(F.try_divide(n * 100.0, of), digits)


def cache_key(*parts: Column) -> Column:
    """The first 12 hex digits of SHA-256 over the parts, separated by NUL."""
    return F.substring(F.sha2(F.concat_ws("\0", *parts), 256), 1, 12)


def _has(message: Column, marks: tuple[str, ...]) -> Column:
    low = F.lower(F.coalesce(message, F.lit("")))
    return F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(low, m))


def is_retryable(status: Column, message: Column) -> Column:
    return F.coalesce(status.isin(*RETRY_CODES), F.lit(False)) | _has(message, RETRY_MARKS)


def is_daily_limit(message: Column) -> Column:
    return _has(message, DAILY_MARKS)


def is_rate_limit(status: Column, message: Column) -> Column:
    return F.coalesce(status == 429, F.lit(False)) | _has(message, RATE_MARKS)


def backoff(attempt: Column, base: float = 1.0, cap: float = 30.0) -> Column:
    """Seconds before the attempt-th retry, without jitter."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt - 1))
