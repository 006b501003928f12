"""Issues by rules: phrases looked up among the word sequences of each text, with severity, sentiment and area."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from themeloom.operators.extraction import ISSUES, MOST_ISSUES
from themeloom.plans.session import materialise, workers_find_package

#: Words of a phrase at most, and rules of a table at most, so that it is broadcast with a known bound.
WORDS, RULES = 4, 50_000
#: Texts that a task looks at together; commonest words among which longer sequences are counted first.
ROWS, KNOWN = 2000, 8192
SCHEMA = "phrase string, theme string, severity string, sentiment string, feature_area string"

#: What a product's parts are called, by area.
_PARTS = {
    "core_listening": "song track player playback queue audio",
    "discovery": "search recommendations feed station charts",
    "social": "comments followers messages profile likes",
    "monetization": "ads subscription payment trial price",
    "account": "login password account email username",
    "stability": "app screen battery update",
    "downloads": "download offline mode files storage",
    "other": "support settings widget notifications",
}
#: What is said of them, with severity and sentiment.
_TROUBLES = {
    "crashes": ("high", "negative"),
    "crashed": ("high", "negative"),
    "freezes": ("high", "negative"),
    "missing": ("high", "negative"),
    "broken": ("high", "negative"),
    "fails": ("high", "negative"),
    "failed": ("high", "negative"),
    "stops": ("medium", "negative"),
    "slow": ("medium", "negative"),
    "confusing": ("medium", "negative"),
    "expensive": ("medium", "negative"),
    "annoying": ("low", "negative"),
    "changed": ("low", "neutral"),
    "better": ("low", "positive"),
    "great": ("low", "positive"),
}


def product_rules(spark: SparkSession) -> DataFrame:
    """The rules that the parts and what is said of them give: `part trouble`, also with is, are or keeps between."""
    rows = []
    for area, parts in _PARTS.items():
        for part in dict.fromkeys(parts.split()):
            for trouble, (severity, sentiment) in _TROUBLES.items():
                for phrase in (f"{part} {trouble}", f"{part} is {trouble}", f"{part} are {trouble}"):
                    rows.append((phrase, f"{part} {trouble}", severity, sentiment, area))
    return spark.createDataFrame(rows, SCHEMA)


def split(text: str | Column) -> Column:
    """What stands between other characters than letters, digits and apostrophes in the lower-cased text; also empty strings."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}']+")


def _words(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The words of split() texts one after the other, and the row of each."""
    flat, row = lists.flatten(), pa.compute.list_parent_indices(lists)
    ok = pa.compute.not_equal(flat, "")
    return flat.filter(ok), row.filter(ok).to_numpy()


def counted(rows: DataFrame, text: str, sizes: list[int], words: list[str] | None = None) -> DataFrame:
    """(phrase, n, c): how often each sequence of n lower-cased words occurs in all texts, for some sizes n.

    Sequences go over what stands between words, not over texts; with `words`, those of these words alone are counted. They
    are counted inside tasks as numbers, a sequence from the one that is a word shorter, and then over all.
    """
    workers_find_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            flat, row = _words(part.column(0))
            held = flat.dictionary_encode()
            words = held.dictionary if shared.value is None else pa.array(shared.value, pa.string())
            word = held.indices if shared.value is None else pa.compute.index_in(flat, value_set=words).fill_null(-1)
            word = word.to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.flatnonzero(word >= 0)
            ids, phrases = word[at], words  # the numbers of the sequences that begin at these places, and what they stand for
            for n in range(1, max(sizes) + 1):
                if n > 1:
                    inside = at + n - 1 < len(word)
                    inside[inside] = (row[at[inside]] == row[at[inside] + n - 1]) & (word[at[inside] + n - 1] >= 0)
                    at = at[inside]
                    held = pa.array(ids[inside] * len(words) + word[at + n - 1]).dictionary_encode()
                    key, ids = held.dictionary.to_numpy(), held.indices.to_numpy().astype(np.int64)
                    before, last = pa.array(key // max(len(words), 1)), pa.array(key % max(len(words), 1))
                    phrases = pa.compute.binary_join_element_wise(phrases.take(before), words.take(last), " ")
                if n in sizes:
                    c = np.bincount(ids, minlength=len(phrases)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([phrases, pa.array(np.full(len(c), n, np.int32)), pa.array(c)], ["phrase", "n", "c"])

    held = rows.select(split(text).alias("w")).where("w is not null").mapInArrow(run, "phrase string, n int, c bigint")
    return held.groupBy("phrase", "n").agg(F.sum("c").alias("c"))


def common(rows: DataFrame, text: str, sizes: list[int], most: int, known: int = KNOWN) -> DataFrame:
    """(phrase, n, c, k): the `most` commonest sequences of each size, with their place k from 1, ties in order of the phrase.

    A sequence is no commoner than the rarest of its words. So longer ones are counted among the `known` commonest words
    first; all are counted only where the last of those found is not commoner than every other word.
    """

    def first(counts: DataFrame) -> DataFrame:
        k = F.row_number().over(Window.partitionBy("n").orderBy(F.col("c").desc(), "phrase"))
        return materialise(counts.withColumn("k", k).where(F.col("k") <= most))

    single = materialise(counted(rows, text, [1]))
    head = single.orderBy(F.col("c").desc(), "phrase").limit(known + 1).collect()
    longer = [n for n in sizes if n > 1]
    out = [first(single)] if 1 in sizes else []
    if longer:
        some = first(counted(rows, text, longer, [r["phrase"] for r in head[:known]]))
        last = {r["n"]: r["c"] for r in some.where(F.col("k") == most).collect()}
        whole = [n for n in longer if len(head) > known and last.get(n, 0) <= head[known]["c"]]
        out.append(some.where(~F.col("n").isin(whole)))
        out += [first(counted(rows, text, whole))] if whole else []
    return reduce(DataFrame.unionByName, out)


def _index(phrases: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
    """The words of phrases; for each length the beginnings of phrases, ascending, as the number of the beginning that is a word
    shorter and of the word; and the phrase that a beginning is, or -1."""
    words = sorted({w for p in phrases for w in p.split(" ")})
    number, known = {w: i for i, w in enumerate(words)}, {(): 0}
    keys, whole = [], []
    asked = {tuple(p.split(" ")): i for i, p in enumerate(phrases)}
    for n in range(1, max(map(len, asked)) + 1):
        heads = sorted({p[:n] for p in asked if len(p) >= n}, key=lambda h: known[h[:-1]] * len(words) + number[h[-1]])
        keys.append(np.array([known[h[:-1]] * len(words) + number[h[-1]] for h in heads], np.int64))
        whole.append(np.array([asked.get(h, -1) for h in heads], np.int64))
        known |= {h: i for i, h in enumerate(heads)}
    return words, keys, whole


def find(reviews: DataFrame, rules: DataFrame, most: int = MOST_ISSUES) -> DataFrame:
    """(review_id, issues) of reviews(review_id, text) in which a rule's phrase stands: the first `most` rules by place.

    rules: SCHEMA, lower-case phrases of WORDS words at most, RULES rows at most, each phrase once. A rule that is met again
    counts at its first place; at one place the shorter phrase comes first. The table is broadcast as an index of word
    sequences, in which all words of a text are looked up where it lies; only issues are dealt anew. Reviews without a text
    or a hit give no row; of rows that repeat an id the first rules of all count.
    """
    table = rules.select("phrase", "theme", "severity", "sentiment", "feature_area").limit(RULES + 1).toArrow().to_pylist()
    if not table:
        return reviews.select("review_id").where("false").withColumn("issues", F.lit(None).cast(ISSUES))
    phrases = [r["phrase"] for r in table]
    if len(table) > RULES or None in phrases or len(set(phrases)) < len(table) or max(len(p.split(" ")) for p in phrases) > WORDS:
        raise ValueError(f"rules are {RULES} at most, each phrase once and of {WORDS} words at most")
    table.sort(key=lambda r: (len(r["phrase"]), r["phrase"].encode()))
    workers_find_package(reviews.sparkSession)
    fields = ["theme", "severity", "sentiment", "feature_area"]
    issues = pa.table({"k": np.arange(len(table), dtype=np.int32), **{c: pa.array([r[c] for r in table], pa.string()) for c in fields}})
    shared = reviews.sparkSession.sparkContext.broadcast((*_index([r["phrase"] for r in table]), issues))

    def first(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, place and rule of the first rules of each of some texts."""
        words, keys, whole, issues = shared.value
        flat, row = _words(lists)
        word = pa.compute.index_in(flat, value_set=pa.array(words, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at, head, met = np.flatnonzero(word >= 0), None, []
        for n, (key, rule) in enumerate(zip(keys, whole, strict=True)):
            if n:
                ok = at + n < len(word)
                ok[ok] = (row[at[ok]] == row[at[ok] + n]) & (word[at[ok] + n] >= 0)
                at, head = at[ok], head[ok]
            asked = word[at + n] if head is None else head * len(words) + word[at + n]
            place = np.minimum(np.searchsorted(key, asked), len(key) - 1)
            ok = key[place] == asked
            at, head = at[ok], place[ok]
            ok = rule[head] >= 0
            met.append(at[ok] * issues.num_rows + rule[head[ok]])
        met = np.sort(np.concatenate(met))
        at, rule = met // issues.num_rows, met % issues.num_rows
        once = np.sort(np.unique(row[at].astype(np.int64) * issues.num_rows + rule, return_index=True)[1])
        at, rule = at[once], rule[once]
        held = row[at]
        ok = np.arange(len(held)) - np.searchsorted(held, held) < most
        at, rule, held = at[ok], rule[ok], held[ok]
        return held, at - np.searchsorted(row, held), rule

    @arrow_udf(f"array<struct<at:int,k:int,{','.join(f'{c}:string' for c in fields)}>>")
    def run(lists: pa.Array) -> pa.Array:
        parts = [(at, first(lists.slice(at, ROWS))) for at in range(0, len(lists), ROWS)]
        row = np.concatenate([at + p[0] for at, p in parts])
        at, rule = (np.concatenate([p[k] for _, p in parts]) for k in (1, 2))
        said = shared.value[3].take(pa.array(rule)).combine_chunks()
        items = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), *[said[c].combine_chunks() for c in ("k", *fields)]], ["at", "k", *fields])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32)), items)

    met = reviews.select("review_id", run.asNondeterministic()(split("text")).alias("x")).where(F.size("x") > 0)
    met = met.groupBy("review_id").agg(F.array_sort(F.flatten(F.collect_list("x"))).alias("x"))  # one row for almost all ids
    again = lambda e, i: F.exists(F.slice("x", 1, i), lambda o: o["k"] == e["k"])
    held = met.select("review_id", F.slice(F.filter("x", lambda e, i: ~again(e, i)), 1, most).alias("x"))
    issue = lambda e: F.struct(*[e[c].alias(c) for c in fields], F.lit("").alias("segment_hint"))
    return held.select("review_id", F.transform("x", issue).cast(ISSUES).alias("issues"))
