"""Ingest operators: normalise, take-while, dedup, union, summaries. All are DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.functions.text import bar, first_truthy, percent, strip


def normalise_android(feed: DataFrame, country: str | Column = "us") -> DataFrame:
    """Reviews from (seq, reviewId, score, content, at, reviewCreatedVersion, appVersion); blank texts and null times go."""
    out = feed.select(
        "seq", F.col("reviewId").alias("review_id"), F.col("score").cast("int").alias("rating"), strip(F.col("content")).alias("text"), F.col("at").cast("timestamp").alias("timestamp"),
        first_truthy(F.col("reviewCreatedVersion"), F.col("appVersion")).alias("app_version"), F.lit("android").alias("platform"), (F.lit(country) if isinstance(country, str) else country).alias("country"),
    )
    return out.where("text <> '' and timestamp is not null")


def normalise_ios(feed: DataFrame) -> DataFrame:
    """Reviews from (seq, id, rating, content, date, app_version, title, country); the key carries the storefront."""
    out = feed.select(
        "seq", F.concat_ws("-", F.lit("ios"), "country", "id").alias("review_id"), F.col("rating").cast("int").alias("rating"), strip(F.col("content")).alias("text"),
        F.col("date").cast("timestamp").alias("timestamp"), first_truthy(F.col("app_version")).alias("app_version"), F.lit("ios").alias("platform"), "country",
        F.coalesce("title", F.lit("")).alias("title"),
    )
    return out.where("text <> ''")


def take_while(feed: DataFrame, cutoff: Column, by: str, order: str = "seq", ts: str = "ts", counts: Column | None = None) -> DataFrame:
    """Rows of each feed before the first one older than cutoff; rows that `counts` is false for never stop it.

    The least `order` past the cutoff is an aggregate of each feed, joined back: no feed is sorted or gathered in a task.
    `order` is any type that compares, without nulls; a null feed is a feed.
    """
    late = (F.col(ts) < cutoff) if counts is None else ((F.col(ts) < cutoff) & counts)
    stops = feed.where(late).groupBy(F.col(by).alias("_feed")).agg(F.min(order).alias("_stop"))
    held = feed.join(stops, F.col(by).eqNullSafe(F.col("_feed")), "left")
    return held.where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).select(*feed.columns)


def accept(feed: DataFrame, cutoff: Column, by: str, key: str, order: str = "seq", ts: str = "ts", text: str = "content") -> DataFrame:
    """The rows of each feed that reading it in order accepts, with the checks one after another.

    A row without a key, or with a key that an accepted row before it has, is passed over; then one without a time; then the
    first row older than cutoff ends the feed; then a blank text is passed over. So skipped rows never end a feed, and a
    blank first copy does not hide a later good one. Up to where a feed ends, a key's accepted row is its least good one:
    aggregates of each key and feed say so, without a sort. Rows come back once for each feed and key.
    """
    good = F.col(key).isNotNull() & (F.col(ts) >= cutoff) & (strip(F.col(text)) != "")
    firsts = feed.where(good).groupBy(F.col(by).alias("_feed"), F.col(key).alias("_key"))
    firsts = firsts.agg(F.min(order).alias("_first"), F.min_by(F.struct(*feed.columns), order).alias("_row"))
    late = feed.where(F.col(key).isNotNull() & (F.col(ts) < cutoff)).select(F.col(by).alias("_f"), F.col(key).alias("_k"), F.col(order).alias("_o"))
    seen = late.join(firsts, F.col("_f").eqNullSafe(F.col("_feed")) & (F.col("_k") == F.col("_key")) & (F.col("_first") < F.col("_o")), "left_anti")
    stops = seen.groupBy("_f").agg(F.min("_o").alias("_stop"))
    held = firsts.join(stops, F.col("_feed").eqNullSafe(F.col("_f")), "left")
    return held.where(F.col("_stop").isNull() | (F.col("_first") < F.col("_stop"))).select("_row.*")


def keep_one(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row for each key, the first in order; ties of order must be broken by it."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_rn = 1").drop("_rn")


def combine(android: DataFrame, ios: DataFrame) -> DataFrame:
    return android.unionByName(ios, allowMissingColumns=True)


def cap_per_group(rows: DataFrame, by: str, n: int, *order: Column) -> DataFrame:
    """The first n rows of each group, with their rank as `rank`."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= n)


def split_by_language(rows: DataFrame, target: str, least: float = 0.5, lang: str = "lang", confidence: str = "confidence") -> DataFrame:
    """rows with kept: the top language is the target, or its confidence is low; no language goes as `unknown`."""
    known = F.col(lang).isNotNull()
    keep = known & ((F.col(lang) == target) | (F.col(confidence) < least))
    return rows.withColumns({
        "kept": F.coalesce(keep, F.lit(False)), "detected_language": F.coalesce(lang, F.lit("unknown")),
        "confidence": F.bround(F.when(known, F.col(confidence)).otherwise(0.0), 4),
    })


def rating_histogram(rows: DataFrame, rating: str = "rating") -> DataFrame:
    """rating, n, pct, bar for each of 1 to 5, zeros shown, and with a null rating for all other rows; shares are of all rows."""
    inside = F.when(F.col(rating).between(1, 5), F.col(rating))
    held = rows.groupBy(inside.alias("held")).agg(F.count("*").alias("c"))
    domain = rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(k).cast("int") for k in (1, 2, 3, 4, 5, None)])).alias("rating"))
    out = domain.join(held, F.col("rating").eqNullSafe(F.col("held")), "left").withColumn("n", F.coalesce("c", F.lit(0)))
    out = out.crossJoin(F.broadcast(held.agg(F.sum("c").alias("t"))))  # one row
    return out.select("rating", "n", percent(F.col("n"), F.col("t"), 1).alias("pct"), bar(F.col("n") * 100.0 / F.col("t")).alias("bar"))
