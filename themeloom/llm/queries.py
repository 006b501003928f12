"""The registered queries of this subpackage: thin digests of each operator's result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.llm import (
    decontam,
    fingerprint,
    langid,
    licences,
    neardup,
    negatives,
    oracles,
    packing,
    periodic,
    simhash,
    suffixdedup,
    tokenbin,
    tokencount,
    toxicity,
)
from themeloom.plans.session import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _fold(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = langid.fit(langid.training_rows(docs, _fold(3) != 1))
    out = langid.identify(docs, model, guess=True)
    return out.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("y")).where(_fold(5) != 0)
    out = toxicity.score(docs, toxicity.fit(toxicity.labelled_rows(docs, labels)))
    return out.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "ratio", "n_words")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(_documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, sf_dir), shingle=4, percent=80)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), most=1024, end_id=2)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(_documents(spark, sf_dir)).drop("kept")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenbin.packed_rows(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), most=2048)
    sums = [F.crc32(c).alias(f"{c}_crc32") for c in ("input_ids", "position_ids", "loss_mask")]
    return rows.select("first_doc", "first_piece", "n_segments", "n_tokens", "doc_ids", "starts", "cu_seqlens", *sums)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return licences.scan(docs, licences.fit(docs))


#: Words of a text, and what op11's contract makes of one in ten: from word a on the first p words of the rest, again and again.
_PLANTED = """
CASE WHEN h % 10 = 0 AND n > 0 THEN array_join(slice(concat(slice(words, 1, a),
  flatten(array_repeat(slice(words, a + 1, p), CAST(ceil((n - a) / p) AS INT)))), 1, n), ' ') ELSE text END
"""
_GREATEST = """
aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
  (best, r) -> IF(best IS NULL OR r.length * best.period > best.length * r.period, r, best))
"""


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"), words.alias("words"))
    rows = rows.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", F.expr("CAST(g % nullif(n, 0) AS INT)"))
    rows = rows.withColumn("p", F.expr("CAST(1 + floor((n - a) / (3 + g % 8)) AS INT)"))
    return rows.select("doc_id", F.expr(_PLANTED).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_planted_runs(_documents(spark, sf_dir)))
    lines = F.expr(r"concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    found = found.withColumn("best", F.expr(_GREATEST))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("floor(1000 * best.length / best.period)").cast("bigint").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    rows = negatives.quantised(table(spark, sf_dir, "embeddings"), label)
    return negatives.hard_negatives(rows, F.col("id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    held = (
        op1_language_id,
        op2_toxicity,
        op3_fingerprints,
        op4_token_counts,
        op5_near_dedup,
        op6_best_fit_packing,
        op7_suffix_dedup,
        op8_token_ids,
        op9_decontamination,
        op10_licence_scan,
        op11_periodic_runs,
        op12_simhash_dedup,
        op13_hard_negatives,
    )
    return {f.__name__: f for f in held}


def oracle_sql() -> dict[str, str]:
    """Language ID, toxicity, tokens, packing, signatures, byte passages, periodic runs and a trained scan are beyond SQL: tests
    hold those against brute force, exact round trips or held-out accuracy."""
    return {"op5_near_dedup": oracles.OP5, "op9_decontamination": oracles.OP9, "op13_hard_negatives": oracles.OP13}
