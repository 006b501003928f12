"""Places over all rows and drawn samples without a task that holds them all."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from themeloom import catalog
from themeloom.operators import sampling
from themeloom.plans.ranking import numbered

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
def test_places_equal_a_sort(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([None, *range(20)])) for i in range(n)]
    frame = spark.createDataFrame(rows, "id int, x int").repartition(5)
    got = numbered(frame, F.col("x").desc(), F.col("id"), name="place")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert sorted((r.place, r.id) for r in got.collect()) == [(k + 1, i) for k, (i, _) in enumerate(want)]
    ranked = {r.id: r.place for r in numbered(frame, F.col("x").desc(), F.col("id"), name="place", key="x").collect()}
    assert ranked == {i: next(k for k, r in enumerate(want) if r[1] == x) + 1 for i, x in rows}


@pytest.mark.parametrize("name", ["score_rank", "cluster_rank", "country_counts", "rank_prevalence_vs_priority"])
def test_no_window_over_everything(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_drawn_rows_are_those_of_least_rank(spark):
    rows = [(i, i % 3, i % 2) for i in range(2000)] + [(5000 + i, None, 0) for i in range(5)]
    frame = spark.createDataFrame(rows, "review_id int, rating int, side int").repartition(6)
    quotas = spark.createDataFrame([(0, 0, 3), (0, 1, 400), (1, 0, 0), (2, 1, 50)], "rating int, side int, n int")
    got = sampling.draw(frame, quotas, ["rating", "side"], seed=7).collect()
    want = []
    for rating, side, n in ((0, 0, 3), (0, 1, 400), (2, 1, 50)):
        own = sorted((hashlib.md5(f"7:{i}".encode()).hexdigest(), i) for i, r, s in rows if (r, s) == (rating, side))
        want += [(i, rating, side, k + 1) for k, (_, i) in enumerate(own[:n])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_samples_deal_only_the_rows_up_to_the_last_rank(spark):
    """Texts of a stratum do not meet in a task: ranks and ids are dealt, then as many rows as the quotas say."""
    docs = spark.range(3000).select(F.col("id").alias("review_id"), (F.col("id") % 3 + 1).cast("int").alias("rating"), F.repeat(F.col("id").cast("string"), 200).alias("text"))
    frame = sampling.fixed(docs.repartition(3), {1: 18, 2: 1, 4: 2}, strict=False)
    salted = [line for line in frame._jdf.queryExecution().optimizedPlan().toString().splitlines() if "_salt" in line]
    assert salted and all("text#" not in line for line in salted)
    got = {}
    for r in frame.collect():
        got.setdefault(r.rating, {})[r.pos] = r.review_id
    for rating, n in ((1, 18), (2, 1)):
        want = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i in range(3000) if i % 3 + 1 == rating)[:n]
        assert got[rating] == {k: i for k, (_, i) in enumerate(want, 1)}
    assert set(got) == {1, 2}
    again = sampling.draw(docs.where("review_id < 4").unionByName(docs.where("review_id = 0")), spark.createDataFrame([(1, 9)], "rating int, n int"), ["rating"])
    assert sorted((r.review_id, r.pos) for r in again.collect()) == sorted((i, k) for k, i in enumerate(sorted([0, 0, 3], key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()), 1))
