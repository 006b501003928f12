"""Members of cluster records as rows: nothing gathers a cluster, and the whole record says the same."""

import pytest
from pyspark.sql import functions as F

from themeloom import catalog
from themeloom.operators import embedding, themes

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["cluster_records", "cluster_record_heads", "quotes_with_platform"])
def test_no_query_gathers_the_members_of_a_cluster(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct(review_id" not in plan and "centroid_sim" in plan


def test_whole_records_hold_the_member_rows(spark):
    rows = [("a", 1, 0, "crash"), ("a", 1, 1, "ads"), ("a", 2, 0, "crash"), ("b", 3, 0, "ads"), ("b", 4, 0, None), ("b", 4, 1, "unknown")]
    issues = spark.createDataFrame(rows, "cluster string, review_id int, issue_pos int, theme string")
    labels = {"severity": "low", "sentiment": "negative", "feature_area": "other", "segment_hint": ""}
    issues = issues.withColumns({k: F.lit(v) for k, v in labels.items()})
    said = issues.where("theme <> 'unknown'").select("theme")
    vectors = embedding.embed(said, "theme", embedding.fit(said, "theme")).withColumnRenamed("text", "theme")
    members = {(r.cluster, r.review_id, r.issue_pos, r.theme, r.centroid_sim) for r in themes.record_members(issues, ["cluster"], vectors).collect()}
    assert {m[:4] for m in members} == set(rows[:4])
    records = themes.cluster_record(issues, ["cluster"], vectors).collect()
    assert {(r.cluster, m.review_id, m.issue_pos, m.theme, m.centroid_sim) for r in records for m in r.members} == members
    assert {(r.cluster, r.label, r.size, r.unique_themes) for r in records} == {("a", "crash", 3, 2), ("b", "ads", 1, 1)}
    assert {r.cluster for r in themes.record_members(issues, ["cluster"], vectors, 2).collect()} == {"a"}
