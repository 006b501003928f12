"""Issues to themes to ranks: explode, breakdowns, weighted score, comparison of platforms."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.functions.text import strip
from themeloom.plans.session import materialise

#: The areas of a product that an issue can belong to.
AREAS = ["core_listening", "discovery", "social", "monetization", "account", "stability", "downloads", "other"]
#: The published weights, the severity scale, the strategic fit of areas and their parents.
WEIGHTS = {"frequency": 0.40, "severity": 0.40, "strategic_fit": 0.20}
SEVERITY = {"low": 1.0, "medium": 2.0, "high": 3.0}
FIT = {"core_listening": 1.0, "stability": 1.0, "discovery": 0.8, "downloads": 0.8, "social": 0.6, "monetization": 0.5, "account": 0.4, "other": 0.3}
PARENT = {
    "core_listening": "app_functionality", "stability": "app_functionality", "downloads": "app_functionality", "account": "app_functionality",
    "other": "app_functionality", "discovery": "discovery", "social": "social", "monetization": "monetization",
}


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def strict_lookup(values: dict, label: Column) -> Column:
    """The value of a label; an unknown or null label is an error."""
    return F.coalesce(F.try_element_at(literal_map(values), label), F.raise_error(F.concat(F.lit("unknown label "), F.coalesce(label, F.lit("null")))))


def cap_issues(rows: DataFrame, most: int = 4) -> DataFrame:
    return rows.withColumn("issues", F.slice("issues", 1, most))


def explode_issues(rows: DataFrame) -> DataFrame:
    """One row for each issue of rows(review_id, issues), blank themes apart; a missing hint is empty."""
    flat = rows.select("review_id", F.posexplode("issues").alias("issue_pos", "i")).select("review_id", "issue_pos", "i.*")
    flat = flat.withColumns({"theme": strip(F.col("theme")), "segment_hint": F.coalesce("segment_hint", F.lit(""))})
    return flat.where("theme <> ''")


def breakdown(issues: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, `value`, n: how often each value occurs; null counts as `null`."""
    return issues.groupBy(*keys, F.coalesce(column, F.lit("null")).alias("value")).agg(F.count("*").alias("n"))


def components(issues: DataFrame, keys: list[str]) -> DataFrame:
    """keys, size, severity_mean, fit_mean; labels outside the scales are errors."""
    return issues.groupBy(*keys).agg(
        F.count("*").alias("size"),
        (F.sum(strict_lookup(SEVERITY, F.col("severity"))) / F.count("*")).alias("severity_mean"),
        (F.sum(strict_lookup({k: round(v * 10) for k, v in FIT.items()}, F.col("feature_area"))) / 10.0 / F.count("*")).alias("fit_mean"),
    )


def score(clusters: DataFrame, floor: int = 10, weights: dict[str, float] | None = None) -> DataFrame:
    """Scored clusters of at least `floor` members: the floor comes before the largest size is taken."""
    w = weights or WEIGHTS
    held = clusters.where(F.col("size") >= floor)
    held = held.crossJoin(F.broadcast(held.agg(F.max("size").alias("_max"))))
    log_max = F.log1p("_max")
    freq = F.when(log_max > 0, F.log1p("size") / log_max).otherwise(0.0)
    held = held.withColumns({"freq_norm": freq, "sev_norm": F.col("severity_mean") / max(SEVERITY.values())}).drop("_max")
    parts = {"freq_part": w["frequency"] * F.col("freq_norm"), "sev_part": w["severity"] * F.col("sev_norm"), "fit_part": w["strategic_fit"] * F.col("fit_mean")}
    return held.withColumns(parts).withColumn("score", F.col("freq_part") + F.col("sev_part") + F.col("fit_part"))


def score_record(scored: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """score()'s rows with `breakdown`: a struct for each component of its normalised value, weight and contribution."""
    w = weights or WEIGHTS
    norm = {"frequency": "freq_norm", "severity": "sev_norm", "strategic_fit": "fit_mean"}
    part = {"frequency": "freq_part", "severity": "sev_part", "strategic_fit": "fit_part"}
    members = [F.struct(F.col(norm[k]).alias("normalized"), F.lit(w[k]).alias("weight"), F.col(part[k]).alias("contribution")).alias(k) for k in norm]
    return scored.withColumn("breakdown", F.struct(*members))


def centroid_sims(issues: DataFrame, keys: list[str], vectors: DataFrame) -> DataFrame:
    """keys, theme, n, centroid_sim: likeness of each theme of a cluster to the normalised mean of its issues' unit vectors.

    vectors(theme, embedding) are sparse (i, x). Issues of equal themes are counted, n, before a vector is joined to them.
    """
    counted = issues.groupBy(*keys, "theme").agg(F.count("*").alias("n")).join(vectors.select("theme", F.col("embedding").alias("_v")), "theme")
    norm = F.sqrt(F.aggregate("_v.x", F.lit(0.0), lambda a, x: a + x * x))
    rows = counted.withColumn("_norm", norm).select(*keys, "theme", "n", "_norm", F.explode(F.arrays_zip("_v.i", "_v.x")).alias("_e"))
    rows = rows.select(*keys, "theme", "n", F.col("_e.i").alias("_i"), (F.col("_e.x") / F.col("_norm")).alias("_u"))
    mean = rows.groupBy(*keys, "_i").agg(F.sum(F.col("n") * F.col("_u")).alias("_m"))
    length = mean.groupBy(*keys).agg(F.sqrt(F.sum(F.col("_m") * F.col("_m"))).alias("_len"))
    dots = rows.join(mean, [*keys, "_i"]).groupBy(*keys, "theme", "n").agg(F.sum(F.col("_u") * F.col("_m")).alias("_dot"))
    return dots.join(length, keys).select(*keys, "theme", "n", (F.col("_dot") / F.col("_len")).alias("centroid_sim"))


def record_members(issues: DataFrame, keys: list[str], vectors: DataFrame, least: int = 1) -> DataFrame:
    """The members of the clusters of `least` issues, a row each: issues with their likeness to the middle of their cluster.

    Nothing gathers a cluster: what is known of it, a row for each of its themes, is written once and joined to the issues.
    """
    sims = materialise(centroid_sims(issues, keys, vectors))
    large = sims.groupBy(*keys).agg(F.sum("n").alias("_size")).where(F.col("_size") >= least)
    return issues.join(sims.join(large, keys, "left_semi").drop("n"), [*keys, "theme"])


def record_heads(issues: DataFrame, keys: list[str], members: DataFrame) -> DataFrame:
    """One row for each cluster of members, which are record_members() of issues: keys, label, size, unique_themes and breakdowns.

    The label is the theme nearest to the middle, ties to the first member. Breakdowns are maps of the values that occur
    (null as `null`).
    """
    counts = [breakdown(issues, keys, c).groupBy(*keys).agg(_as_map("value", "n").alias(f"{c}_breakdown")) for c in ("sentiment", "severity", "feature_area")]
    first = F.max_by("theme", F.struct("centroid_sim", -F.col("review_id"), -F.col("issue_pos")))
    out = members.groupBy(*keys).agg(first.alias("label"), F.count("*").alias("size"), F.count_distinct("theme").alias("unique_themes"))
    for c in counts:
        out = out.join(c, keys)
    return out.select(*keys, "label", "size", "unique_themes", "sentiment_breakdown", "severity_breakdown", "feature_area_breakdown")


def cluster_record(issues: DataFrame, keys: list[str], vectors: DataFrame, least: int = 1) -> DataFrame:
    """One record for each cluster of `least` issues: record_heads() and members.

    issues(review_id, issue_pos, theme, severity, sentiment, feature_area, segment_hint and keys); vectors(theme, embedding)
    sparse. Members are structs in order of review and place, each with its likeness to the middle. A record holds its
    members, so keys have to be selective; record_members() gives the members of any cluster as rows.
    """
    held = record_members(issues, keys, vectors, least)
    member = F.struct("review_id", "issue_pos", "theme", "severity", "sentiment", "feature_area", "segment_hint", "centroid_sim")
    members = held.groupBy(*keys).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return record_heads(issues, keys, held).join(members, keys)


def _as_map(key: str, value: str) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))


def issue_rich_first(rows: DataFrame, n: int) -> DataFrame:
    """The n rows(review_id, issues) with most issues, ties by review_id."""
    return rows.orderBy(F.size("issues").desc(), "review_id").limit(n)


def skew_label(a: Column, i: Column, even: float = 1.2) -> Column:
    """What two shares say: `Android 4.5x`, `iOS only`, `~ even (iOS 1.1x)`; null without any."""
    ratio = F.try_divide(F.greatest(a, i), F.least(a, i))
    side = F.when(a >= i, "Android").otherwise("iOS")
    times = F.format_string("%.1f", F.bround(ratio, 1))
    said = F.when(F.greatest(a, i) == 0, None).when(F.least(a, i) == 0, F.concat(side, F.lit(" only")))
    said = said.when(ratio < even, F.concat(F.lit("~ even ("), side, F.lit(" "), times, F.lit("x)")))
    return said.otherwise(F.concat(side, F.lit(" "), times, F.lit("x")))


def platform_skew(counts: DataFrame, even: float = 1.2, least: int = 3) -> DataFrame:
    """(theme, a, i, share_a, share_i, skew) from counts(theme, a, i, n_a, n_i) of themes with evidence on a side."""
    held = counts.where(F.greatest("a", "i") >= least).withColumns({"share_a": F.col("a") / F.col("n_a"), "share_i": F.col("i") / F.col("n_i")})
    return held.withColumn("skew", skew_label(F.col("share_a"), F.col("share_i"), even))


def medoids(members: DataFrame, keys: list[str], vec: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """keys, id_col, sim: likeness of each member to the normalised mean of its cluster's normalised vectors.

    Vectors of a cluster have one length. They are summed inside tasks, and a task hands on one vector for each cluster.
    """
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = members.select(*keys, id_col, F.transform(vec, lambda x: x.cast("double") / F.greatest(norm, F.lit(1e-12))).alias("u"))
    centre = unit.groupBy(*keys).agg(vector_to_array(Summarizer.mean(array_to_vector("u"))).alias("c"))
    centre = centre.withColumn("len", F.sqrt(F.aggregate("c", F.lit(0.0), lambda a, x: a + x * x)))
    both = unit.join(centre, keys)
    dot = F.aggregate(F.zip_with("u", "c", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return both.select(*keys, id_col, (dot / F.greatest("len", F.lit(1e-12))).alias("sim"))
