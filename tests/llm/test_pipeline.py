"""The pipeline's stages: each hands on the columns of documents and its decisions take effect."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from themeloom.llm import decontam, neardup

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    extra = spark.createDataFrame(
        [(900001, None, "en", "s", 0), (900002, "123", None, "s", 3), (None, "the words that have no number of their own", "en", "s", 9)],
        docs.schema,
    )
    docs = docs.union(extra).withColumns({c: F.lit(None).cast("string") for c in ("score", "spans", "n", "g", "kept", "band")})
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name == "language_id":
            assert docs.count() == before + 1
        if name == "near_dedup":
            assert neardup.near_duplicates(docs).where("not kept").count() == 0
        if name == "decontamination":
            assert decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        if name != "best_fit_packing":
            assert docs.columns == columns
            left = docs.count()
    assert docs.select("doc_id").distinct().count() == left
    assert docs.where("doc_id is null").count() == 1
    assert corpus_pipeline.run(spark, SF).count() == docs.count() - 1


@pytest.mark.parametrize("lang", ["en", None])
def test_language_stage_keeps_texts_with_letters(spark, lang):
    rows = [(1, "the cat and the dog", lang), (2, "สวัสดี ครับ", None), (3, "12 !", None), (4, None, None)]
    got = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), SF).collect()
    assert {r.doc_id: r.lang for r in got} == {1: lang or "und", 2: lang or "und"}


def test_decontamination_judges_rows_without_an_id(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, f"before it {item} and after", "x"), (None, "a clean text of its own words", "x"), (None, None, "y"), (7, f"here {item} too", "y"), (8, "another clean text", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string")
    got = corpus_pipeline.drop_benchmark_leaks(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(rows[k]) for k in (1, 2, 4))
    assert corpus_pipeline.drop_benchmark_leaks(spark, docs.limit(0), SF).count() == 0


def test_near_duplicate_stage_keeps_the_greatest_text_of_a_repeated_id(spark):
    rows = [(1, "a text of one kind", 5), (1, "b text of another kind", None), (2, "quite different words here", 1), (None, "x", 2), (None, "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(rows[k]) for k in (1, 2, 3, 4))


def test_every_stage_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
        if name != "best_fit_packing":
            assert out.columns == docs.columns
