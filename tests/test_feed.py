"""Where a feed stops and what it accepts, against reading it row by row; language profiles on held-out texts."""

import datetime as dt
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from themeloom import catalog
from themeloom.operators import feed, language

SF = "/root/testdata/sf0.001"


def plain_accept(rows, cutoff):
    out = []
    for name in {r[0] for r in rows}:
        seen = set()
        for _, seq, key, ts, text in sorted((r for r in rows if r[0] == name), key=lambda r: r[1]):
            if key is None or key in seen or ts is None:
                continue
            if ts < cutoff:
                break
            if not (text or "").strip():
                continue
            seen.add(key)
            out.append((name, seq, key))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_accepted_rows_equal_reading_in_order(spark, seed):
    rng = random.Random(seed)
    day = lambda n: dt.datetime(2024, 1, n)
    rows = []
    for name in ("a", "b", None, "c"):
        for seq in range(40):
            late = rng.random() < 0.06 * seed
            key = rng.choice([None, *"klmnop"])
            ts = None if rng.random() < 0.1 else day(rng.randint(1, 9) if late else rng.randint(10, 20))
            rows.append((name, seq, key, ts, rng.choice(["x", " \t", None, "y "])))
    frame = spark.createDataFrame(rows, "feed string, seq int, id string, ts timestamp, content string").repartition(4)
    got = feed.accept(frame, F.lit(day(10)), "feed", "id")
    assert got.columns == frame.columns
    assert sorted(((r.feed, r.seq, r.id) for r in got.collect()), key=str) == plain_accept(rows, day(10))


@pytest.mark.parametrize("name", ["window_take_while", "feed_accept"])
def test_no_window_in_the_plan(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def _accuracy(spark, sf, cut=None):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    profile = language.fit(docs.where(fold != 1))
    held = docs.where((fold == 1) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    if cut:
        held = held.withColumn("text", F.substring("text", 1, cut))
    found = language.detect(held, profile).select("lang", F.col("ranked")[0]["lang"].alias("found"))
    return found.agg(F.avg((F.col("lang") == F.col("found")).cast("double"))).first()[0]


def test_held_out_accuracy(spark):
    assert _accuracy(spark, "/root/testdata/sf0.01") > 0.99
    assert _accuracy(spark, "/root/testdata/sf0.01", 40) > 0.9


def test_profile_edges(spark, tmp_path):
    rows = [(1, "the cat and the hat", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", "de"), (5, "12 !?", "fr"), (6, "the dog", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language.fit(docs).save(str(tmp_path / "profile"))
    profile = language.Profile.load(spark, str(tmp_path / "profile"))
    assert profile.languages == ["de", "en"]
    asked = spark.createDataFrame(
        [(1, "the\nhat", "x"), (1, "und die", "y"), (None, "THE HAT", "z"), (7, None, None), (8, "жук", ""), (1, "the\nhat", "w")],
        "doc_id long, text string, ranked_ string",
    )
    got = language.detect(asked, profile)
    assert got.columns == [*asked.columns, "ranked"] and got.count() == 6
    found = {r.ranked_: r.ranked and r.ranked[0].lang for r in got.collect()}
    assert found == {"x": "en", "y": "de", "z": "en", None: None, "": None, "w": "en"}
    assert all(abs(sum(x.p for x in r.ranked) - 1) < 1e-12 for r in got.collect() if r.ranked)
    split = {r.ranked_: (r.kept, r.detected_language, r.confidence) for r in language.split(asked, profile, "en").collect()}
    assert split["x"][:2] == (True, "en") and split[None] == (False, "unknown", 0.0) and not split["y"][0]
    with pytest.raises(ValueError, match="unsupported"):
        language.split(asked, profile, "xx")
    assert language.detect(asked, language.fit(docs.limit(0))).where("ranked is not null").count() == 0


@pytest.mark.parametrize("step", [3, 1 << 21])
def test_each_text_is_judged_where_it_is(spark, monkeypatch, step):
    """Detection deals no text anew and explodes nothing; sums over pieces of texts are those of whole ones."""
    monkeypatch.setattr(language, "STEP", step)
    rows = [(1, "the cat", "en"), (2, "le chat noir", "fr"), (3, "der Hund", "de"), (4, "", "en"), (5, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profile = language.fit(docs)
    weight = {r.gram: r.w for r in profile.table.collect()}
    texts = ["The cat, the CAT; le-chat", "", None, "12", "жук", "\U0001d4d0at der", "hund" * 9, "_cat_"]
    found = language.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), profile)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    for r in found.collect():
        words = "".join(c if c.isalpha() else " " for c in (r.text or "").lower()).split()
        grams = [g for w in words for i in range(len(w)) if (g := f"_{w}_"[i : i + 3]) in weight]
        sums = [sum(weight[g][k] for g in grams) for k in range(3)]
        want = [math.exp((x - max(sums)) / 3000) for x in sums]
        want = {k: x / sum(want) for k, x in zip(profile.languages, want, strict=True)} if grams else None
        assert (r.ranked and {x.lang: x.p for x in r.ranked}) == (want and pytest.approx(want))
