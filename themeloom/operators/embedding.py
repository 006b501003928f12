"""Sparse vectors of short texts: hashed character trigrams weighted by an IDF that is fitted once and kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots that trigrams are hashed to; at most 2**20, what five hexadecimal digits tell apart.
SLOTS = 1 << 18
SPARSE = "struct<i:array<int>,x:array<double>>"


def _counts(texts: DataFrame, text: str, slots: int) -> DataFrame:
    """(text, slot, tf) of each distinct text.

    A text is lower-cased and stands between two spaces, so that an empty one (and a null, which counts as empty) has a
    trigram too and no vector is zero. A slot is the first 20 bits of the trigram's md5, modulo `slots`.
    """
    held = texts.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()
    padded = F.concat(F.lit(" "), F.lower("text"), F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - 2, F.lit(1))), lambda i: F.substring(padded, i, F.lit(3)))
    slot = lambda g: (F.conv(F.substring(F.md5(g), 1, 5), 16, 10).cast("int") % slots)
    return held.select("text", F.explode(F.transform(grams, slot)).alias("slot")).groupBy("text", "slot").agg(F.count("*").alias("tf"))


def fit(texts: DataFrame, text: str, slots: int = SLOTS) -> DataFrame:
    """(slot, df, n): in how many of the n distinct texts a slot occurs; at most `slots` rows. Slot -1 has n alone."""
    counts = _counts(texts, text, slots)
    known = counts.groupBy("slot").agg(F.count("*").alias("df"))
    total = texts.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct().agg(F.count("*").alias("n"))
    return known.unionByName(total.select(F.lit(-1).alias("slot"), F.lit(0).cast("bigint").alias("df"), "n"), allowMissingColumns=True)


def save(model: DataFrame, path: str) -> None:
    model.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("slot int, df bigint, n bigint").parquet(path)


def _idf(df: Column, n: Column) -> Column:
    return F.log((1.0 + n) / (1.0 + F.coalesce(df, F.lit(0)))) + 1.0


def weights(texts: DataFrame, text: str, model: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(text, slot, weight) of each distinct text: tf * (ln((1 + n) / (1 + df)) + 1); a slot that the model lacks has df 0."""
    counts = _counts(texts, text, slots)
    known = F.broadcast(model.where("slot >= 0").select("slot", "df"))  # at most `slots` rows
    total = F.broadcast(model.where("slot = -1").select("n"))  # one row
    held = counts.join(known, "slot", "left").crossJoin(total)
    return held.select("text", "slot", (F.col("tf") * _idf(F.col("df"), F.col("n"))).alias("weight"))


def embed(texts: DataFrame, text: str, model: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(text, embedding) of each distinct text: weights() as ascending slots and their values, not normalised."""
    rows = weights(texts, text, model, slots).groupBy("text").agg(F.array_sort(F.collect_list(F.struct("slot", "weight"))).alias("w"))
    return rows.select("text", F.struct(F.col("w.slot").alias("i"), F.col("w.weight").alias("x")).alias("embedding"))
