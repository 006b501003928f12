"""Language detection: a profile of letter trigrams fitted on labelled texts, looked up for the trigrams of each text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from themeloom.operators import feed
from themeloom.plans.session import materialise, workers_find_package

#: Trigrams of a language that a profile keeps: its commonest, ties in order of the trigram.
MOST = 2000
#: Languages of a profile at most, so that its table is broadcast with a known bound.
LANGUAGES = 400
#: Weights are thousandths of a natural logarithm; overlapping trigrams count a letter three times.
UNIT, OVERLAP = 1000, 3
#: Trigrams that a task looks at together, times the languages; what it holds does not depend on the length of a text.
STEP = 1 << 21


@dataclass
class Profile:
    """For each trigram a weight in each of the languages, which are in alphabet order; LANGUAGES * MOST rows at most."""

    languages: list[str]
    table: DataFrame

    def save(self, path: str) -> None:
        named = self.table.select("gram", F.array(*map(F.lit, self.languages)).cast("array<string>").alias("languages"), "w")
        named.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Profile:
        held = spark.read.schema("gram string, languages array<string>, w array<bigint>").parquet(path)
        first = held.select("languages").first()
        return Profile(list(first["languages"]) if first else [], held.select("gram", "w"))

    def check_target(self, code: str) -> str:
        """A language that detection knows; any other is an error."""
        if code not in self.languages:
            raise ValueError(f"unsupported language {code!r}; known: {self.languages}")
        return code


def marked(text: str | Column) -> Column:
    """The lower-cased words of letters of a text, with a mark before and after each."""
    return F.concat(F.lit("_"), F.regexp_replace(F.lower(text), r"[^\p{L}]+", "_"), F.lit("_"))


def trigrams(texts: list[str], step: int) -> Iterator[tuple[int, np.ndarray]]:
    """The trigrams of marked() texts one after the other, some at a time: where they begin, and three code points of 21 bits
    as a number for each place; -1 where the middle is a mark, so that no trigram is of two words (or texts)."""
    joined = "".join(texts)
    for at in range(0, len(joined) - 2, step):
        c = np.frombuffer(joined[at : at + step + 2].encode("utf-32-le"), np.uint32).astype(np.int64)
        yield at, np.where(c[1:-1] == ord("_"), -1, c[:-2] << 42 | c[1:-1] << 21 | c[2:])


def _counted(labelled: DataFrame) -> DataFrame:
    """(gram, lang, c): the trigrams of each language of (lang, text), counted inside tasks and then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch["lang"].unique():
                texts = batch["text"].filter(pa.compute.equal(batch["lang"], lang)).drop_null().to_pylist()
                for _, keys in trigrams(texts, STEP):
                    key, c = np.unique(keys[keys >= 0], return_counts=True)
                    points = np.stack([key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
                    grams = [points[i : i + 3] for i in range(0, len(points), 3)]
                    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.repeat(lang, len(key)), pa.array(c)], ["gram", "lang", "c"])

    held = labelled.select("lang", marked("text").alias("text"))
    return held.mapInArrow(run, "gram string, lang string, c bigint").groupBy("gram", "lang").agg(F.sum("c").alias("c"))


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", most: int = MOST) -> Profile:
    """The profile of labelled texts: naive Bayes with one added to each count; rows without a text or label teach nothing.

    Weights are whole numbers, so that sums over a text do not depend on their order.
    """
    labelled = rows.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    workers_find_package(rows.sparkSession)
    counts = materialise(_counted(labelled))
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if len(languages) > LANGUAGES:
        raise ValueError(f"a profile has {LANGUAGES} languages at most")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("c").desc(), "gram"))
    common = counts.withColumn("_rn", place).where(F.col("_rn") <= most).select("gram").distinct()
    wide = counts.join(common, "gram").groupBy("gram").pivot("lang", languages).agg(F.sum("c"))
    wide = materialise(wide.select("gram", F.array(*[F.coalesce(F.col(f"`{k}`"), F.lit(0)) for k in languages]).cast("array<bigint>").alias("c")))
    total = wide.agg(F.count("*").alias("v"), F.array(*[F.sum(F.col("c")[k]) for k in range(len(languages))]).cast("array<bigint>").alias("n"))
    weight = F.zip_with("c", "n", lambda c, n: F.round(UNIT * F.log((c + 1.0) / (n + F.col("v")))).cast("bigint"))
    return Profile(languages, materialise(wide.crossJoin(F.broadcast(total)).select("gram", weight.alias("w"))))  # total is one row


def _sums(profile: Profile):
    """A function that gives each marked() text the sum of its trigrams' weights in each language, null without a known one.

    The profile is broadcast: LANGUAGES * MOST rows at most.
    """
    rows = profile.table.select("gram", "w").toArrow()
    points = np.frombuffer("".join(rows["gram"].to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, 3)
    n, width = len(rows), len(profile.languages)
    weight = np.zeros((n + 1, width + 1), np.int64)  # the last column counts, the last row is of unknown trigrams
    weight[:n, :width] = np.array(rows["w"].to_pylist(), np.int64).reshape(n, width)
    weight[:n, width] = 1
    shared = profile.table.sparkSession.sparkContext.broadcast((points[:, 0] << 42 | points[:, 1] << 21 | points[:, 2], weight))

    @arrow_udf("array<bigint>")
    def run(texts: pa.Array) -> pa.Array:
        keys, weight = shared.value
        known, texts = pa.array(keys), texts.fill_null("").to_pylist()
        ends = np.cumsum([0, *map(len, texts)])
        out = np.zeros((len(texts), weight.shape[1]), np.int64)
        for at, gram in trigrams(texts, max(STEP // weight.shape[1], 1)):
            row = pa.compute.index_in(pa.array(gram), value_set=known).fill_null(len(keys)).to_numpy(zero_copy_only=False)
            upto = np.concatenate([np.zeros((1, weight.shape[1]), np.int64), np.cumsum(weight[row], axis=0)])
            lo, hi = np.searchsorted(ends, at, "right") - 1, np.searchsorted(ends, at + len(gram), "left")
            place = np.clip(ends[lo : hi + 1] - at, 0, len(gram))
            out[lo:hi] += upto[place[1:]] - upto[place[:-1]]
        found = out[:, -1] > 0
        sizes = np.where(found, weight.shape[1] - 1, 0)
        flat = pa.array(out[found, :-1].ravel())
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat, mask=pa.array(~found))

    return run.asNondeterministic()  # so that it is called once for each text, however its result is used


def detect(rows: DataFrame, profile: Profile, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """rows with `ranked`, (lang, p) for each language by falling p, ties in alphabet order; null without a known trigram.

    p is the posterior of even odds. Each row is judged where it is: nothing is dealt anew, ids may repeat.
    """
    names = profile.languages
    if not names:
        return rows.withColumn("ranked", F.lit(None).cast("array<struct<lang:string,p:double>>"))
    workers_find_package(rows.sparkSession)
    held = rows.withColumn("_s", _sums(profile)(marked(text)))
    odds = F.array(*[F.struct(F.lit(k).alias("lang"), F.exp((F.col("_s")[i] - F.array_max("_s")) / (UNIT * OVERLAP)).alias("p")) for i, k in enumerate(names)])
    held = held.withColumn("_odds", F.when(F.col("_s").isNotNull(), odds))
    share = F.aggregate("_odds", F.lit(0.0), lambda s, x: s + x["p"])
    fair = F.transform("_odds", lambda x: F.struct((-x["p"] / share).alias("q"), x["lang"].alias("lang")))
    ranked = F.transform(F.array_sort(fair), lambda x: F.struct(x["lang"].alias("lang"), (-x["q"]).alias("p")))
    return held.select(*rows.columns, ranked.alias("ranked"))


def top(ranked: str = "ranked") -> tuple[Column, Column]:
    """The first language and its p, 0 without one."""
    return F.col(ranked)[0]["lang"], F.coalesce(F.col(ranked)[0]["p"], F.lit(0.0))


def split(rows: DataFrame, profile: Profile, target: str, least: float = 0.5, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """rows with kept, detected_language and confidence: kept if the target is found, or anything with little confidence.

    A text in which nothing is found goes as `unknown`. An unknown target is an error.
    """
    profile.check_target(target)
    found, p = top()
    held = detect(rows, profile, text, id_col).select(*rows.columns, found.alias("_lang"), p.alias("_p"))
    return feed.split_by_language(held, target, least, "_lang", "_p").drop("_lang", "_p")
