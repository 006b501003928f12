"""Extraction runs: each review's result once, a stop that running tasks see, and every attempt as a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from themeloom.operators.extraction import ISSUES, MOST_ISSUES, backend, with_retry
from themeloom.plans.session import workers_find_package
from themeloom.sources.shared import Marker, open_folder

#: Buckets of review ids, the unit that a run writes; fixed, as a review has to stay in its bucket for good.
BUCKETS = 64
ATTEMPTS = "array<struct<at:timestamp,attempt:int,kind:string,said:string,waited:double>>"

_ISSUE = pa.list_(pa.struct([(c, pa.string()) for c in ("theme", "severity", "sentiment", "feature_area", "segment_hint")]))
_ATTEMPT = pa.list_(
    pa.struct([("at", pa.timestamp("us", "UTC")), ("attempt", pa.int32()), ("kind", pa.string()), ("said", pa.string()), ("waited", pa.float64())]),
)


@dataclass
class Report:
    """What a run did: counts of this run's calls, and whether a daily cap stopped it."""

    calls: int = 0
    retries: int = 0
    rate_limited: int = 0
    server: int = 0
    done: int = 0
    failed: int = 0
    left: int = 0
    capped: bool = False

    def add(self, seen: dict) -> None:
        for k, v in seen.items():
            setattr(self, k, getattr(self, k) + (v or 0))


def _bucket(id_col: str = "review_id"):
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(BUCKETS)).cast("int")


def results(spark: SparkSession, path: str, cache_key: str, id_type: str = "string") -> DataFrame:
    """(review_id, issues, status, attempts) of a key, a row for each review; none where nothing was written.

    Only a missing folder counts as empty: any other fault is an error, or all calls would be paid for again.
    """
    schema = f"review_id {id_type}, issues {ISSUES}, status string, attempts {ATTEMPTS}, cache_key string, bucket int"
    try:
        held = spark.read.schema(schema).parquet(f"{path}/results")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        held = spark.createDataFrame([], schema)
    return held.where(F.col("cache_key") == cache_key).drop("cache_key")


def cached(spark: SparkSession, path: str, cache_key: str, id_type: str = "string") -> DataFrame:
    """(review_id, issues) of the reviews that are done."""
    return results(spark, path, cache_key, id_type).where("status = 'ok'").select("review_id", "issues")


def dead_letters(spark: SparkSession, path: str, cache_key: str, id_type: str = "string") -> DataFrame:
    """(review_id, status, said) of the reviews that failed for good, with what the last attempt said."""
    held = results(spark, path, cache_key, id_type).where("status = 'failed'")
    return held.select("review_id", "status", F.try_element_at("attempts", F.lit(-1))["said"].alias("said"))


def attempts(spark: SparkSession, path: str, cache_key: str, id_type: str = "string") -> DataFrame:
    """The attempt log: (review_id, at, attempt, kind, said, waited)."""
    return results(spark, path, cache_key, id_type).select("review_id", F.explode("attempts").alias("a")).select("review_id", "a.*")


def last_events(log: DataFrame, n: int = 50) -> DataFrame:
    """The latest n attempts that did not succeed."""
    return log.where("kind <> 'ok'").orderBy(F.col("at").desc(), F.col("review_id"), F.col("attempt").desc()).limit(n)


def throughput(log: DataFrame, total: int) -> DataFrame:
    """One row from the attempt log: done, calls, seconds, reviews_per_second, calls_per_minute, seconds_left of `total` reviews."""
    done = F.count_if(F.col("kind") == "ok").alias("done")
    seconds = (F.unix_micros(F.max("at")) - F.unix_micros(F.min("at"))) / 1e6
    held = log.agg(done, F.count("*").alias("calls"), seconds.alias("seconds"))
    rate = F.try_divide(F.col("done"), F.col("seconds"))
    per_minute = F.try_divide(60 * F.col("calls"), F.col("seconds"))
    left = F.try_divide(F.lit(total) - F.col("done"), rate)
    return held.select("*", rate.alias("reviews_per_second"), per_minute.alias("calls_per_minute"), left.alias("seconds_left"))


def _called(todo: DataFrame, provider: str, stop: Marker, tasks: int, retry: dict) -> DataFrame:
    """(review_id, issues, status, attempts) of each review, called in `tasks` tasks at once."""
    make: Callable = backend(provider)
    workers_find_package(todo.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            issues, status, tries = [], [], []
            for text in batch.column(1).to_pylist():
                found, said, log = with_retry(lambda t=text: call(t or ""), stopped=stop.up, **retry)
                if said == "daily_cap" and log:
                    stop.put()
                issues.append(None if found is None else found[:MOST_ISSUES])
                status.append(said)
                tries.append([{"at": datetime.fromtimestamp(a["at"], UTC), **{k: a[k] for k in ("attempt", "kind", "said", "waited")}} for a in log])
            columns = [batch.column(0), pa.array(issues, _ISSUE), pa.array(status, pa.string()), pa.array(tries, _ATTEMPT)]
            yield pa.RecordBatch.from_arrays(columns, names=["review_id", "issues", "status", "attempts"])

    kind = todo.schema["review_id"].dataType.simpleString()
    schema = f"review_id {kind}, issues {ISSUES}, status string, attempts {ATTEMPTS}"
    return todo.repartition(tasks).mapInArrow(run, schema)


def _staged(path: str, cache_key: str) -> tuple[str, Marker]:
    at = f"{path}/staged/{cache_key}"
    return at, Marker(f"{at}/_SUCCESS")


def _publish(spark: SparkSession, path: str, cache_key: str, id_type: str) -> None:
    """Put a whole staged wave in the place of the buckets it covers; again and again with the same result."""
    at, _ = _staged(path, cache_key)
    schema = f"review_id {id_type}, issues {ISSUES}, status string, attempts {ATTEMPTS}, cache_key string, bucket int"
    rows = spark.read.schema(schema).parquet(at)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cache_key", "bucket").parquet(f"{path}/results")
    store, folder = open_folder(at)
    store.delete_dir(folder)


def run(reviews: DataFrame, path: str, cache_key: str, provider: str, tasks: int = 5, waves: int = 8, **retry) -> Report:
    """Call a backend for the reviews (review_id, text) that have no result under a key, in waves of buckets.

    A wave's results are staged, with the buckets' earlier ones, and then replace those buckets whole. If the run is killed
    before a wave is staged, that wave is called again; after that, the next run publishes what is staged and calls nothing
    twice. So each review has one row, however often a run is killed and repeated. A daily cap raises a marker in the shared
    folder `path`, which every task looks at before each call: no task calls any more, and the run ends with what it has. The
    next run starts afresh. Failed reviews are tried again by it. Reviews without an id are left out; of a repeated one
    any text is taken. `retry`: retries, base, cap of with_retry.
    """
    spark, report = reviews.sparkSession, Report()
    kind = reviews.schema["review_id"].dataType.simpleString()
    at, whole = _staged(path, cache_key)
    if whole.up():
        _publish(spark, path, cache_key, kind)
    stop = Marker(f"{path}/stop/{cache_key}")
    stop.clear()
    reviews = reviews.where("review_id is not null").select("review_id", "text", _bucket().alias("bucket"))
    for wave in range(waves):
        own = F.col("bucket") % waves == wave
        held = results(spark, path, cache_key, kind).where(own)
        todo = reviews.where(own).join(held.where("status = 'ok'"), "review_id", "left_anti").dropDuplicates(["review_id"])
        if stop.up():
            report.left += todo.count()
            continue
        seen = Observation()
        tries = lambda k: F.sum(F.size(F.filter("attempts", lambda a: a["kind"] == k)))
        fresh = _called(todo.select("review_id", "text"), provider, stop, tasks, retry).observe(
            seen,
            F.sum(F.size("attempts")).alias("calls"),
            F.sum(F.greatest(F.size("attempts") - 1, F.lit(0))).alias("retries"),
            tries("rate_limit").alias("rate_limited"),
            tries("server").alias("server"),
            F.count_if(F.col("status") == "ok").alias("done"),
            F.count_if(F.col("status") == "failed").alias("failed"),
            F.count_if(F.col("status") == "daily_cap").alias("left"),
        )
        kept = held.where("status = 'ok'").drop("bucket")
        both = fresh.unionByName(kept).withColumns({"cache_key": F.lit(cache_key), "bucket": _bucket()})
        both.write.mode("overwrite").parquet(at)
        report.add(seen.get)
        _publish(spark, path, cache_key, kind)
    report.capped = stop.up()
    return report
