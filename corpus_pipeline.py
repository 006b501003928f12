"""The corpus pipeline: five stages over the table of documents, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from themeloom.llm import decontam, langid, neardup, packing, suffixdedup
from themeloom.plans.session import materialise, settle, table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter (null and letterless texts go); a null lang becomes the one found, `und` if none is learned."""
    model = langid.fit(langid.training_rows(docs, F.lit(True)))
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    found = langid.identify(rows, model, keep=("_row",), guess=True)
    found = found.where((F.col("lang_pred") != "und") | F.col("_row.text").rlike(r"\p{L}"))
    lang = F.coalesce("_row.lang", "lang_pred").alias("lang")
    return found.select(*[lang if c == "lang" else F.col("_row")[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest doc_id (five-word shingles, 0.8).

    Rows that repeat a doc_id are one document, that of the greatest text; those without a doc_id are linked with nothing
    and stay.
    """
    kept = materialise(neardup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct())
    one = docs.join(kept.hint("merge"), "doc_id", "left_semi")
    order = Window.partitionBy("doc_id").orderBy(F.col("text").desc(), F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind]))
    one = one.withColumn("_first", F.row_number().over(order)).where("_first = 1").select(*docs.columns)
    return one.union(docs.where("doc_id is null"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of smaller doc_id has too; n_chars is counted anew."""
    kept = {c: f"_keep{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
    rows = docs.select("doc_id", "text", *[F.col(c).alias(k) for c, k in kept.items()])
    out = suffixdedup.remove_repeats(rows, keep=tuple(kept.values()))
    out = out.select("doc_id", F.col("kept").alias("text"), *[F.col(k).alias(c) for c, k in kept.items()])
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def _without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    leaks = materialise(decontam.contaminated(docs, benchmark).select("doc_id").distinct())
    few = leaks.count() <= decontam.BROADCAST_ROWS
    return docs.join(F.broadcast(leaks) if few else leaks.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (0.8 of its five-word shingles); rows without a doc_id are judged by their text."""
    benchmark = table(spark, sf_dir, "benchmark")
    clean = _without_leaks(docs.where("doc_id is not null"), benchmark)
    loose = docs.where("doc_id is null")
    if loose.isEmpty():
        return clean
    keyed = loose.select(F.xxhash64("text").alias("doc_id"), "text", F.struct(*docs.columns).alias("_row"))
    return clean.union(_without_leaks(keyed, benchmark).select("_row.*"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of what is left."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), most=1024, end_id=2)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again as the next one's documents."""
    docs, since = table(spark, sf_dir, "documents"), written()
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), since)  # what a stage wrote on its way goes
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language ID, links and packing are not expressible in SQL: the stages are tested against brute force instead.
ORACLE_SQL = None
