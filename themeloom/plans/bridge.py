"""Views of the given tables as reviews, issues, clusters and feeds; each with its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from themeloom.operators import themes
from themeloom.plans.session import table

_AREA_SQL = "[" + ", ".join(f"'{a}'" for a in themes.AREAS) + "]"
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

#: WITH clauses for DuckDB.
REVIEWS = """reviews AS (SELECT o_orderkey AS review_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating,
  CASE o_orderstatus WHEN 'F' THEN 'android' WHEN 'O' THEN 'ios' END AS platform, lower(n_name) AS country,
  o_orderdate AS ts, c_mktsegment AS app_version
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
ISSUES = f"""issues AS (SELECT l_orderkey AS review_id,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) - 1 AS issue_pos, l_linenumber AS line,
  CASE l_returnflag WHEN 'R' THEN 'high' WHEN 'A' THEN 'medium' ELSE 'low' END AS severity,
  CASE l_linestatus WHEN 'F' THEN 'negative' ELSE 'positive' END AS sentiment,
  ({_AREA_SQL})[l_partkey % 8 + 1] AS feature_area, p_name AS theme
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
FIT_CASE = "CASE feature_area " + " ".join(f"WHEN '{a}' THEN {round(v * 10)}" for a, v in themes.FIT.items()) + " END"
CLUSTERS = f"""clusters AS (SELECT theme, sentiment, count(*) AS size,
  sum(CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END)::DOUBLE / count(*) AS severity_mean,
  sum({FIT_CASE})::DOUBLE / 10.0 / count(*) AS fit_mean FROM issues GROUP BY theme, sentiment)"""


def reviews(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    held = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return held.select(
        F.col("o_orderkey").alias("review_id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.when(F.col("o_orderstatus") == "F", "android").when(F.col("o_orderstatus") == "O", "ios").alias("platform"),
        F.lower("n_name").alias("country"), F.col("o_orderdate").alias("ts"), F.col("c_mktsegment").alias("app_version"),
    )


def issues(spark: SparkSession, d: str, positions: bool = False) -> DataFrame:
    """Flat issues; the window that numbers them inside a review is added only where it is needed."""
    li, p = table(spark, d, "lineitem"), table(spark, d, "part").select("p_partkey", "p_name")
    if positions:
        li = li.withColumn("issue_pos", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)) - 1)
    held = li.join(p, li.l_partkey == p.p_partkey)
    return held.select(
        F.col("l_orderkey").alias("review_id"), *(["issue_pos"] if positions else []), F.col("l_linenumber").alias("line"),
        F.when(F.col("l_returnflag") == "R", "high").when(F.col("l_returnflag") == "A", "medium").otherwise("low").alias("severity"),
        F.when(F.col("l_linestatus") == "F", "negative").otherwise("positive").alias("sentiment"),
        F.element_at(F.array(*map(F.lit, themes.AREAS)), (F.col("l_partkey") % 8 + 1).cast("int")).alias("feature_area"), F.col("p_name").alias("theme"),
    )


def clusters(spark: SparkSession, d: str) -> DataFrame:
    return themes.components(issues(spark, d), ["theme", "sentiment"])


def nested(spark: SparkSession, d: str) -> DataFrame:
    """(review_id, issues): the issues of a review in order, as an array."""
    s = F.struct("issue_pos", "theme", "severity", "sentiment", "feature_area", F.lit(None).cast("string").alias("segment_hint"))
    held = issues(spark, d, True).groupBy("review_id").agg(F.array_sort(F.collect_list(s)).alias("x"))
    return held.select(
        "review_id",
        F.transform("x", lambda i: F.struct(*[i[c].alias(c) for c in ("theme", "severity", "sentiment", "feature_area", "segment_hint")])).alias(
            "issues",
        ),
    )


#: Model issues are the odd lines of an order (four at most), gold ones the even lines.
PAIRS = """sides AS (SELECT review_id, line % 2 AS odd, feature_area, severity,
  row_number() OVER (PARTITION BY review_id, line % 2 ORDER BY issue_pos) - 1 AS k, theme FROM issues)"""


def model_and_gold(spark: SparkSession, d: str) -> DataFrame:
    """(review_id, model, gold) of the orders that have both."""
    s = F.struct("issue_pos", "feature_area", "severity")
    side = lambda odd: F.array_sort(F.collect_list(F.when(F.col("line") % 2 == odd, s)))
    held = issues(spark, d, True).groupBy("review_id").agg(side(1).alias("m"), side(0).alias("g")).where("size(m) > 0 and size(g) > 0")
    cut = lambda c: F.transform(c, lambda i: F.struct(i["feature_area"].alias("feature_area"), i["severity"].alias("severity")))
    return held.select("review_id", F.slice(cut("m"), 1, 4).alias("model"), cut("g").alias("gold"))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """(review_id, review_text, has_issue, model, gold) of all orders: odd lines are the model's issues, even ones gold."""
    i = issues(spark, d, True)
    side = lambda odd, name: F.array_sort(
        F.collect_list(F.when(F.col("line") % 2 == odd, F.struct("issue_pos", F.col("theme").alias(name), "feature_area", "severity")))
    )
    held = i.groupBy("review_id").agg(side(1, "theme").alias("model"), side(0, "desc").alias("gold"))
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("review_id"), F.col("o_orderpriority").alias("review_text"))
    none = F.lit(None).cast("boolean")
    out = r.join(held, "review_id", "left").withColumn("has_issue", F.when(F.col("review_id") % 5 == 0, F.size("gold") > 0).otherwise(none))
    empty = lambda c, name: F.coalesce(c, F.array().cast(f"array<struct<issue_pos:int,{name}:string,feature_area:string,severity:string>>"))
    return out.withColumns({"model": F.slice(empty(F.col("model"), "theme"), 1, 4), "gold": empty(F.col("gold"), "desc")})


FEED = """feed AS (SELECT event_id, event_type AS feed, user_id % 500 AS rid, ts,
  CASE WHEN event_id % 11 = 0 THEN '  ' ELSE props END AS content,
  row_number() OVER (PARTITION BY event_type ORDER BY ts + to_hours(CAST(event_id % 7 AS INTEGER)) DESC, event_id) AS seq FROM events)"""


def feed(spark: SparkSession, d: str) -> DataFrame:
    """Feeds in an order that disagrees with their times; `seq` is a pair that compares, so nothing is numbered."""
    e = table(spark, d, "events")
    shifted = F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("event_id") % 7) * 3_600_000_000
    content = F.when(F.col("event_id") % 11 == 0, "  ").otherwise(F.col("props"))
    seq = F.struct((-shifted).alias("at"), F.col("event_id"))
    return e.select("event_id", F.col("event_type").alias("feed"), (F.col("user_id") % 500).alias("rid"), "ts", content.alias("content"), seq.alias("seq"))
