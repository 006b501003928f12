"""Evaluation: pair scores, greedy one-to-one matching inside a row, and the metrics over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.operators.themes import PARENT, SEVERITY, literal_map

ISSUE = "array<struct<feature_area:string,severity:string>>"


def pair_score(m: Column, g: Column) -> Column:
    """2 for the same area, 1 for the same severity or 0.5 for one apart; null equals null."""
    level = literal_map(SEVERITY)
    apart = F.abs(F.try_element_at(level, m["severity"]) - F.try_element_at(level, g["severity"]))
    area = F.when(m["feature_area"].eqNullSafe(g["feature_area"]), 2.0).otherwise(0.0)
    return area + F.when(m["severity"].eqNullSafe(g["severity"]), 1.0).when(apart == 1.0, 0.5).otherwise(0.0)


def candidates(model: Column, gold: Column) -> Column:
    """(score, mi, gi) of all pairs of one row with a positive score, best first; ties to larger places."""
    pairs = F.flatten(
        F.transform(model, lambda m, mi: F.transform(gold, lambda g, gi: F.struct(pair_score(m, g).alias("score"), mi.alias("mi"), gi.alias("gi")))),
    )
    return F.sort_array(F.filter(pairs, lambda p: p["score"] > 0), asc=False)


def greedy(cands: Column) -> Column:
    """The pairs that are left when each in turn takes its two places if both are free."""
    empty = F.array().cast("array<struct<score:double,mi:int,gi:int>>")
    free = lambda acc, p: ~F.exists(acc, lambda q: (q["mi"] == p["mi"]) | (q["gi"] == p["gi"]))
    return F.aggregate(cands, empty, lambda acc, p: F.when(free(acc, p), F.concat(acc, F.array(p))).otherwise(acc))


def match(rows: DataFrame) -> DataFrame:
    """rows(model, gold) with matches, unmatched_model and unmatched_gold (places from 0)."""
    out = rows.withColumn("matches", greedy(candidates(F.col("model"), F.col("gold"))))

    def rest(items: str, place: str) -> Column:
        every = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(every, lambda i: ~F.exists("matches", lambda q: q[place] == i))

    return out.withColumns({"unmatched_model": rest("model", "mi"), "unmatched_gold": rest("gold", "gi")})


def metrics(matched: DataFrame) -> DataFrame:
    """One row: issue counts, matches, and how they agree by area, parent area and severity."""
    pairs = F.transform("matches", lambda q: F.struct(F.get("model", q["mi"]).alias("m"), F.get("gold", q["gi"]).alias("g")))
    parent, level = literal_map(PARENT), literal_map(SEVERITY)
    count = lambda test: F.sum(F.size(F.filter(pairs, test)))
    return matched.agg(
        F.sum(F.size("model")).alias("n_model"),
        F.sum(F.size("matches")).alias("n_matched"),
        count(lambda q: q["m"]["feature_area"].eqNullSafe(q["g"]["feature_area"])).alias("area_strict"),
        count(lambda q: F.coalesce(F.try_element_at(parent, q["m"]["feature_area"]) == F.try_element_at(parent, q["g"]["feature_area"]), F.lit(False))).alias("area_parent"),
        count(lambda q: q["m"]["severity"].eqNullSafe(q["g"]["severity"])).alias("severity_exact"),
        count(lambda q: F.coalesce(F.abs(F.try_element_at(level, q["m"]["severity"]) - F.try_element_at(level, q["g"]["severity"])) <= 1, F.lit(False))).alias("severity_within_one"),
    )


def match_records(matched: DataFrame) -> DataFrame:
    """review_id, k (from 0, by score), mi, gi, score, model_area, gold_area, area_match, severity_match of match()'s pairs."""
    rows = matched.select("review_id", "model", "gold", F.posexplode("matches").alias("k", "c"))
    m, g = F.get("model", F.col("c.mi")), F.get("gold", F.col("c.gi"))
    return rows.select(
        "review_id", "k", "c.mi", "c.gi", "c.score", m["feature_area"].alias("model_area"), g["feature_area"].alias("gold_area"),
        (m["feature_area"] == g["feature_area"]).alias("area_match"), (m["severity"] == g["severity"]).alias("severity_match"),
    )


def match_record(matched: DataFrame) -> DataFrame:
    """One record for each of match()'s rows(review_id, review_text, has_issue, model, gold): what a person needs to judge it.

    review_id, review_text (null: empty), gold_has_issue (has_issue, or whether gold has issues where that is null),
    model_has_issue, matches (model, gold, feature_area_match, severity_match; best first) and the issues of either side that
    are left, in their order. Model issues keep theme, area and severity, gold ones desc, area and severity.
    """
    model = lambda i: F.struct(*[i[c].alias(c) for c in ("theme", "feature_area", "severity")])
    gold = lambda i: F.struct(*[i[c].alias(c) for c in ("desc", "feature_area", "severity")])
    same = lambda q, c: F.get("model", q["mi"])[c].eqNullSafe(F.get("gold", q["gi"])[c])
    pair = lambda q: F.struct(
        model(F.get("model", q["mi"])).alias("model"),
        gold(F.get("gold", q["gi"])).alias("gold"),
        same(q, "feature_area").alias("feature_area_match"),
        same(q, "severity").alias("severity_match"),
    )
    return matched.select(
        "review_id",
        F.coalesce("review_text", F.lit("")).alias("review_text"),
        F.coalesce("has_issue", F.size("gold") > 0).alias("gold_has_issue"),
        (F.size("model") > 0).alias("model_has_issue"),
        F.transform("matches", pair).alias("matches"),
        F.transform("unmatched_model", lambda i: model(F.get("model", i))).alias("unmatched_model_issues"),
        F.transform("unmatched_gold", lambda i: gold(F.get("gold", i))).alias("unmatched_gold_issues"),
    )


def common_ids(model: DataFrame, gold: DataFrame, key: str = "review_id") -> tuple[DataFrame, int, int]:
    """The ids of both sides, and how many only the model and only gold has; a side without rows is an error."""
    for side, rows in (("model", model), ("gold", gold)):
        if rows.isEmpty():
            raise ValueError(f"no {side} rows: label and extract the sample before comparing")
    a, b = model.select(key).distinct(), gold.select(key).distinct()
    return a.intersect(b), a.exceptAll(b).count(), b.exceptAll(a).count()


def confusion(rows: DataFrame, gold: Column, model: Column) -> DataFrame:
    """gold_has, model_has, n: all four cells, empty ones as 0."""
    sides = F.explode(F.array(F.lit(True), F.lit(False)))
    cells = rows.sparkSession.range(1).select(sides.alias("gold_has")).select("gold_has", sides.alias("model_has"))
    held = rows.groupBy(gold.alias("gold_has"), model.alias("model_has")).agg(F.count("*").alias("c"))
    return cells.join(held, ["gold_has", "model_has"], "left").select("gold_has", "model_has", F.coalesce("c", F.lit(0)).alias("n"))
