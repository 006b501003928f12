"""The rule table against a plain search, and the schema that one declaration gives."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from themeloom.operators import extraction, rules
from themeloom.operators.schema import Declaration, Field

ISSUE = ("theme", "severity", "sentiment", "feature_area", "segment_hint")


def plain(text, table, most=4):
    words = re.findall(r"[^\W_]+(?:'[^\W_]*)*|'+[^\W_]*", text.lower()) if text else []
    met = {}
    for n in (1, 2, 3):
        for at in range(len(words) - n + 1):
            phrase = " ".join(words[at : at + n])
            if phrase in table:
                met.setdefault(phrase, at)
    first = sorted(met, key=lambda p: (met[p], len(p), p))[:most]
    return [table[p] for p in first]


def test_product_rules_are_found_in_texts(spark):
    table = rules.product_rules(spark)
    assert 500 < table.count() < rules.RULES and table.count() == table.select("phrase").distinct().count()
    known = {r.phrase: tuple(r)[1:] for r in table.collect()}
    rng = random.Random(1)
    phrases = sorted(known)
    texts = [(i, rng.choice([", ", " - ", "  "]).join(rng.choice([rng.choice(phrases).title(), "word", "it's", "don't"]) for _ in range(rng.randint(0, 9)))) for i in range(200)]
    texts += [(900, None), (901, ""), (902, "APP   CRASHES!! the app crashes; ads are annoying"), (903, "login")]
    got = {r.review_id: r.issues for r in rules.find(spark.createDataFrame(texts, "review_id long, text string"), table).collect()}
    want = {i: plain(t, known) for i, t in texts}
    assert {i: [tuple(x)[:4] for x in v] for i, v in got.items()} == {i: v for i, v in want.items() if v}
    assert [x.theme for x in got[902]] == ["app crashes", "ads annoying"] and got[902][0].severity == "high"


def test_rules_that_cannot_be(spark):
    texts = spark.createDataFrame([(1, "a b")], "review_id long, text string")
    table = spark.createDataFrame([("a b", "t", "low", "neutral", "other")], rules.SCHEMA)
    assert rules.find(texts, table.limit(0)).count() == 0
    assert rules.find(texts.limit(0), table).count() == 0
    with pytest.raises(ValueError, match="once"):
        rules.find(texts, table.union(table))
    with pytest.raises(ValueError, match="words"):
        rules.find(texts, table.withColumn("phrase", F.lit("a b c d e")))


def test_one_declaration_gives_types_and_schema():
    held = extraction.DECLARATION
    assert held.item_type().fieldNames() == list(ISSUE) and held.ddl() == extraction.ISSUES
    items = held.json_schema()["properties"]["issues"]
    assert items["maxItems"] == 4 and items["items"]["required"] == list(ISSUE)
    small = Declaration("rows", (Field("a", ("x", "y"), "what it is"), Field("b")), 2)
    assert small.json_schema()["properties"]["rows"]["items"]["properties"] == {"a": {"type": "string", "enum": ["x", "y"], "description": "what it is"}, "b": {"type": "string"}}


def test_arguments_are_parsed_and_checked(spark):
    good = dict(zip(ISSUE, ("t", "low", "neutral", "other", ""), strict=True))
    bare = {k: v for k, v in good.items() if k != "segment_hint"}
    rows = {
        "none": (None, [], []),
        "empty": ("", [], []),
        "no items": ("{}", [], []),
        "null items": ('{"issues": null}', [], []),
        "cut": (json.dumps({"issues": [good]})[:-4], [], ["malformed"]),
        "words": ("I see no issues", [], ["malformed"]),
        "good": (json.dumps({"issues": [good, good], "more": 1}), ["t", "t"], []),
        "many": (json.dumps({"issues": [good] * 6}), ["t"] * 4, ["too many"]),
        "label": (json.dumps({"issues": [good, good | {"severity": "grave"}]}), ["t", "t"], ["1.severity=grave"]),
        "missing": (json.dumps({"issues": [bare, good | {"theme": None}]}), ["t", None], ["0.segment_hint missing", "1.theme missing"]),
    }
    frame = spark.createDataFrame([(k, v[0]) for k, v in rows.items()], "k string, a string")
    got = frame.select("k", extraction.DECLARATION.parse(F.col("a")).alias("p")).collect()
    assert {r.k: ([x.theme for x in r.p.issues], list(r.p.problems)) for r in got} == {k: (v[1], v[2]) for k, v in rows.items()}


@pytest.mark.parametrize("together", [1, 3, 2000])
def test_sequences_are_counted_and_found_where_texts_lie(spark, monkeypatch, together):
    """Numbers of words in place of exploded phrases: the same counts and rules, over slices of a batch, nulls and repeated ids."""
    monkeypatch.setattr(rules, "ROWS", together)
    rng = random.Random(together)
    texts = [(i, None if i % 7 == 3 else " ".join(rng.choice(["a", "b", "'c", "dd", ";", "é"]) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    texts += [(50, "b b a"), (50, "a b"), (51, "x"), (51, "dd")]
    frame = spark.createDataFrame(texts, "review_id long, text string").coalesce(1)
    want = {}
    for _, t in texts:
        words = re.findall(r"[\w']+", t) if t else []
        for n in (1, 3):
            for at in range(len(words) - n + 1):
                key = (" ".join(words[at : at + n]), n)
                want[key] = want.get(key, 0) + 1
    assert {(r.phrase, r.n): r.c for r in rules.counted(frame, "text", [1, 3]).collect()} == want
    for most, known in ((4, 2), (2, 3), (50, 1), (3, 100)):
        got = rules.common(frame, "text", [1, 3], most, known).collect()
        best = {n: sorted((-c, p) for (p, m), c in want.items() if m == n)[:most] for n in (1, 3)}
        assert {(r.n, r.k, r.phrase, r.c) for r in got} == {(n, k, p, -c) for n, v in best.items() for k, (c, p) in enumerate(v, 1)}
    table = [(p, f"t {p}", "low", "neutral", "other") for p in ("a", "b", "a b", "b a b", "'c dd", "dd a é", "é", "b 'c", "q")]
    found = rules.find(frame, spark.createDataFrame(table, rules.SCHEMA))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and "Window" not in plan
    got = {r.review_id: [tuple(x)[:4] for x in r.issues] for r in found.collect()}
    once = {i: plain(t, {r[0]: r[1:] for r in table}) for i, t in texts if i < 50}
    assert {i: v for i, v in got.items() if i < 50} == {i: v for i, v in once.items() if v}
    assert [x[0] for x in got[50]] == ["t a", "t b", "t a b"] and 51 not in got
