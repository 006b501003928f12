"""Benchmark decontamination: MinHash containment search of short items in long documents, verified exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.plans.session import materialise

#: Upper sizes (shingles) of the partitions of items and how many minima stand for an item of each.
#: An item with containment c keeps each of its minima in the document with probability c at least, without
#: replacement, so at c = 0.8 all m are lost with probability under 0.2**m: 3e-6 for 8, 5e-9 for 12.
PARTITIONS = [(16, 16), (64, 8), (256, 10), (None, 12)]
#: Rows of minima, and of candidate pairs, up to which they are broadcast; beyond, a shuffle joins them.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array for texts without one and for null."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def shingles(held: Column, k: int) -> Column:
    """The k-word shingles of an array of words, as strings; an empty array if it has fewer words."""
    at = F.sequence(F.lit(1), F.size(held) - (k - 1))
    return F.when(F.size(held) < k, F.array().cast("array<string>")).otherwise(F.transform(at, lambda i: F.array_join(F.slice(held, i, k), " ")))


def shingle_hashes(held: Column, k: int) -> Column:
    """Their 64-bit hashes, without building the strings."""
    at = F.sequence(F.lit(0), F.size(held) - k)
    return F.when(F.size(held) < k, F.array().cast("array<bigint>")).otherwise(
        F.transform(at, lambda i: F.xxhash64(*[F.get(held, i + F.lit(j)) for j in range(k)]))
    )


def item_index(benchmark: DataFrame, k: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, k, n, shingles): the distinct shingles of each item that has a word.

    Items of fewer than k words are one shingle of their own length. Repeated ids: the greatest text speaks.
    """
    items = benchmark.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("item_id")).agg(F.max(F.col(text_col).cast("string")).alias("text"))
    items = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    own = F.when(F.size("w") < k, F.array(F.array_join("w", " "))).otherwise(F.array_distinct(shingles(F.col("w"), k)))
    return items.select("item_id", F.least(F.size("w"), F.lit(k)).alias("k"), F.size(own).alias("n"), own.alias("shingles"))


def _any_size(w: Column, most: int) -> Column:
    """shingle_hashes of an array of k words, k = 1 to most: its one hash."""
    return F.coalesce(*[F.when(F.size(w) == k, F.xxhash64(*[F.get(w, F.lit(j)) for j in range(k)])) for k in range(1, most + 1)])


def minima(items: DataFrame, most: int, share: float) -> DataFrame:
    """(hash, k, item_id, need): the least hashes of the shingles of each item, as many as its size partition has, and how
    many of them a document has for certain that holds `share` of the item: all but as many as it may lack shingles."""
    many = F.lit(PARTITIONS[-1][1])
    for top, m in reversed(PARTITIONS[:-1]):
        many = F.when(F.col("n") <= top, F.lit(m)).otherwise(many)
    each = items.select("item_id", "k", "n", F.explode("shingles").alias("s")).select("item_id", "k", "n", F.split("s", " ").alias("w"))
    hashes = each.select("item_id", "k", "n", _any_size(F.col("w"), most).alias("hash"))
    least = hashes.groupBy("item_id", "k", "n").agg(F.array_sort(F.collect_set("hash")).alias("h"))
    need = F.greatest(F.lit(1), F.size("low") - F.floor(F.col("n") * (1 - share) + 1e-9)).cast("int")
    least = least.select("item_id", "k", "n", F.slice("h", F.lit(1), many).alias("low"))
    return least.select("item_id", "k", need.alias("need"), F.explode("low").alias("hash"))


def _with_size(hashes: Column, k: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(k).alias("k"), h.alias("hash")))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle: int = 5, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of each document and item of at least that containment.

    Containment: the share of an item's distinct shingles that stand in the document. Items are partitioned
    by size; each is found through the least hashes of its shingles (more or all of them for other sizes),
    looked up among all shingles of the whole document; what is found is verified on the shingles
    themselves. Null, empty and wordless texts and items match nothing; null ids are left out; documents
    that repeat an id are one (the greatest text speaks); no documents or items give no rows.
    """
    items = materialise(item_index(benchmark, shingle))
    index = materialise(minima(items, shingle, share))
    small = index.count() <= BROADCAST_ROWS
    bound = F.broadcast if small else (lambda df: df)
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most `shingle` values
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if not sizes:
        empty = docs.where("false").select("doc_id", F.lit(0).cast(items.schema["item_id"].dataType).alias("item_id"))
        return empty.select("*", F.lit(0).alias("n_item"), F.lit(0).alias("n_shared"), F.lit(0.0).alias("containment"))
    held = docs.select("doc_id", words(F.col("text")).alias("w"))
    keyed = [_with_size(shingle_hashes(F.col("w"), k), k) for k in sizes]
    found = held.select("doc_id", F.explode(F.concat(*keyed)).alias("x")).select("doc_id", "x.k", "x.hash")
    pairs = found.join(bound(index), ["k", "hash"]).groupBy("doc_id", "item_id", "need").agg(F.count_distinct("hash").alias("hits"))
    pairs = materialise(pairs.where("hits >= need"))
    hot = pairs.select("doc_id").distinct()
    few = pairs.count() <= BROADCAST_ROWS
    texts = docs.join(F.broadcast(hot) if few else hot, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text"))
    texts = texts.select("doc_id", words(F.col("text")).alias("w"))
    strings = F.concat(*[shingles(F.col("w"), k) for k in sizes])
    exact = pairs.join(texts.select("doc_id", strings.alias("d")), "doc_id").join(bound(items), "item_id")
    shared = F.size(F.array_intersect("shingles", "d"))
    out = exact.select("doc_id", "item_id", F.col("n").alias("n_item"), shared.alias("n_shared"))
    return out.where(F.col("n_shared") >= F.col("n_item") * share).withColumn("containment", F.col("n_shared") / F.col("n_item"))
