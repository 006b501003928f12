"""Sparse theme vectors from a kept model, and average linkage over blocks against plain versions."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from themeloom import catalog
from themeloom.operators import clustering, embedding

SF = "/root/testdata/sf0.001"


def _slot(gram, slots=embedding.SLOTS):
    return int(hashlib.md5(gram.encode()).hexdigest()[:5], 16) % slots


def _grams(text):
    p = f" {text.lower()} "
    return [p[i : i + 3] for i in range(max(len(p) - 2, 1))]


def _dense(vec):
    return dict(zip(vec["i"], vec["x"], strict=True))


def _cosine(a, b):
    dot = sum(x * b.get(k, 0.0) for k, x in a.items())
    return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))


@pytest.mark.parametrize("slots", [16, embedding.SLOTS])
def test_embedding_weights_hashed_trigrams_by_the_model(spark, tmp_path, slots):
    texts = ["Crash on start", "crash at login", "", None, "ads", "ads", "naïve é"]
    known = {t or "" for t in texts}
    df = {}
    for t in known:
        for k in {_slot(g, slots) for g in _grams(t)}:
            df[k] = df.get(k, 0) + 1
    rows = spark.createDataFrame([(t,) for t in texts], "said string")
    embedding.save(embedding.fit(rows, "said", slots), str(tmp_path / "model"))
    model = embedding.load(spark, str(tmp_path / "model"))
    new = spark.createDataFrame([("crash of zebras",), ("ads",), (None,)], "said string")
    for frame, held in ((rows, known), (new, {"crash of zebras", "ads", ""})):
        got = {r.text: _dense(r.embedding) for r in embedding.embed(frame, "said", model, slots).collect()}
        assert set(got) == held
        for t, vec in got.items():
            want = {}
            for g in _grams(t):
                want[_slot(g, slots)] = want.get(_slot(g, slots), 0) + 1
            want = {k: n * (math.log((1 + len(known)) / (1 + df.get(k, 0))) + 1) for k, n in want.items()}
            assert vec == pytest.approx(want) and list(vec) == sorted(vec)
    assert embedding.embed(rows.limit(0), "said", model, slots).count() == 0


def test_unlike_themes_are_nearly_orthogonal(spark):
    names = ["crash on start", "too many ads", "lost my playlist", "crashes on startup"]
    rows = spark.createDataFrame([(t,) for t in names], "t string")
    got = {r.text: _dense(r.embedding) for r in embedding.embed(rows, "t", embedding.fit(rows, "t")).collect()}
    assert _cosine(got[names[0]], got[names[3]]) > 0.4
    assert max(abs(_cosine(got[a], got[b])) for a in names[:3] for b in names[:3] if a != b) < 0.1


def test_equal_themes_cluster_by_their_embedding(spark):
    names = ["crash on start", "crash at start", "too many ads", "so many ads", "playlist lost"]
    rows = spark.createDataFrame([("p", t) for t in names], "part string, theme string")
    points = rows.join(embedding.embed(rows, "theme", embedding.fit(rows, "theme")).withColumnRenamed("text", "theme"), "theme")
    for small in (clustering.SMALL, 0):
        got = {r.theme: r.cluster for r in clustering.average_linkage(points, 0.75, "part", "theme", "embedding", small=small).collect()}
        assert got["crash on start"] == got["crash at start"] and got["too many ads"] == got["so many ads"]
        assert len(set(got.values())) == 3


def test_blocks_of_a_large_part_equal_one_task(spark, monkeypatch):
    """5,000 vectors of one key: rounds over blocks give what one matrix gives, without a join of all pairs."""
    monkeypatch.setattr(clustering, "BLOCK", 700)
    rng = np.random.default_rng(2)
    v = np.repeat(rng.standard_normal((500, 24)), 10, axis=0) + 0.45 * rng.standard_normal((5000, 24))
    rows = spark.createDataFrame([("k", i, x.tolist()) for i, x in enumerate(v)], "part string, id long, v array<double>").repartition(4)
    got = {r.id: r.cluster for r in clustering.average_linkage(rows, 0.5, "part", "id", "v", small=0).collect()}
    u = np.round(v / np.linalg.norm(v, axis=1, keepdims=True), 12)
    want = clustering.merge_small(np.arange(5000), u @ u.T, np.ones(5000), 0.5)
    assert [got[i] for i in range(5000)] == want.tolist()
    assert 300 < len(set(want.tolist())) < 1000
    state = rows.select("part", F.col("id").alias("cid"), F.lit(1).cast("bigint").alias("size"), clustering.sparse(rows, "v").alias("u"))
    plan = clustering.nearest(*[state.select("part", "cid", "size", "u.i", "u.x")] * 2)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_zero_vectors_are_errors(spark):
    rows = spark.createDataFrame([(0, 0, [0.0, 0.0])], "part int, id int, v array<double>")
    with pytest.raises(PySparkException):
        clustering.average_linkage(rows, 0.5, "part", "id", "v").collect()
    assert clustering.average_linkage(rows.limit(0), 0.5, "part", "id", "v").count() == 0


def test_theme_clusters_equal_a_plain_run(spark):
    """The registered query against trigram vectors and one-at-a-time merging in plain Python."""
    got = catalog.queries()["theme_clusters"](spark, SF)
    part = [r.p_name for r in spark.read.parquet(f"{SF}/part.parquet").select("p_name").distinct().collect()]
    counts = {t: {} for t in part}
    for t in part:
        for g in _grams(t):
            counts[t][_slot(g)] = counts[t].get(_slot(g), 0) + 1
    df = {}
    for c in counts.values():
        for k in c:
            df[k] = df.get(k, 0) + 1
    vec = {t: {k: n * (math.log((1 + len(part)) / (1 + df[k])) + 1) for k, n in c.items()} for t, c in counts.items()}
    held = {}
    for r in got.collect():
        held.setdefault(r.part, {})[r.theme] = r.cluster
    for themes in list(held.values())[:4]:
        names = sorted(themes)
        gram = np.array([[_cosine(vec[a], vec[b]) for b in names] for a in names])
        groups = [[i] for i in range(len(names))]
        while len(groups) > 1:
            far = [(1 - gram[np.ix_(x, y)].mean(), i, j) for i, x in enumerate(groups) for j, y in enumerate(groups) if i < j]
            dist, i, j = min(far)
            if dist >= 0.55:
                break
            groups[i] += groups.pop(j)
        assert themes == {names[i]: names[min(g)] for g in groups for i in g}


def test_rounds_broadcast_no_clusters(spark, monkeypatch):
    """What a round joins are sides that grow with the clusters: by shuffles, so that nothing of them goes through the driver."""
    written, keep = [], clustering.materialise
    monkeypatch.setattr(clustering, "materialise", lambda df: written.append(df) or keep(df))
    v = np.random.default_rng(3).standard_normal((300, 4))
    rows = spark.createDataFrame([("k", i, x.tolist()) for i, x in enumerate(v)], "part string, id long, v array<double>")
    out = clustering.average_linkage(rows, 0.3, "part", "id", "v", small=0)
    for df in [*written, out]:
        for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
            assert "BroadcastHashJoin" not in line or "BroadcastHashJoin [part#" in line and "cid" not in line and "other" not in line


def test_a_part_may_take_more_rounds_than_two_hundred(spark):
    """Each vector is nearer to all before it than to the ones after it: one pair merges a round, 209 times."""
    n, near = 215, 210
    alike = 0.9 - 0.8 * np.arange(n) / n
    gram = alike[np.maximum.outer(np.arange(n), np.arange(n))]
    np.fill_diagonal(gram, 1)
    v = np.linalg.cholesky(gram)
    rows = spark.createDataFrame([("k", i, x.tolist()) for i, x in enumerate(v)], "part string, id long, v array<double>")
    threshold = float(1 - alike[near - 1 : near + 1].mean())
    got = {r.id: r.cluster for r in clustering.average_linkage(rows, threshold, "part", "id", "v", small=0).collect()}
    assert got == {i: 0 if i < near else i for i in range(n)}


@pytest.mark.parametrize("small, room, pairs", [(0, 0, 0), (0, 1 << 23, 60_000), (300, 0, 0)])
def test_parts_go_from_rounds_to_one_task(spark, monkeypatch, small, room, pairs):
    """Rounds over blocks to the end, or until a task can hold the part, give what one matrix gives; repeated vectors count."""
    written, keep = [], clustering.materialise
    monkeypatch.setattr(clustering, "materialise", lambda df: written.append(df.columns) or keep(df))
    monkeypatch.setattr(clustering, "ROOM", room)
    monkeypatch.setattr(clustering, "PAIRS", pairs)
    monkeypatch.setattr(clustering, "BLOCK", 150)
    rng = np.random.default_rng(4)
    v = {k: np.repeat(rng.standard_normal((n // 5, 12)), 5, axis=0) + 0.4 * rng.standard_normal((n, 12)) for k, n in (("a", 450), ("b", 200))}
    held = [(k, 2 * i + copy, x.tolist()) for k, xs in v.items() for i, x in enumerate(xs) for copy in range(1 + (i % 7 == 0))]
    rows = spark.createDataFrame(held, "part string, id long, v array<double>").repartition(3)
    got = {(r.part, r.id): r.cluster for r in clustering.average_linkage(rows, 0.6, "part", "id", "v", small=small).collect()}
    rounds = written.count(["part", "cid", "size", "i", "x"]) // 2
    assert len(got) == len(held) and (rounds > 5 if not small and not room else 0 < rounds < 5)
    for k, xs in v.items():
        u = np.round(xs / np.linalg.norm(xs, axis=1, keepdims=True), 12)
        size = 1.0 + (np.arange(len(xs)) % 7 == 0)
        want = clustering.merge_small(np.arange(len(xs)), u @ u.T * np.outer(size, size), size, 0.6)
        assert all(got[k, 2 * i] == 2 * w and got.get((k, 2 * i + 1), 2 * w) == 2 * w for i, w in enumerate(want.tolist()))
        assert 1 < len(set(want.tolist())) < len(xs) / 2


def test_known_neighbours_are_gone_on_from(monkeypatch):
    """Rounds by mean vectors, with some neighbours known and products held a few rows at a time, end as rounds by all products."""
    monkeypatch.setattr(clustering, "CELLS", 2000)
    rng = np.random.default_rng(5)
    v = np.repeat(rng.standard_normal((60, 10)), 5, axis=0) + 0.4 * rng.standard_normal((300, 10))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    far = np.round(1 - u @ u.T, 12)
    np.fill_diagonal(far, np.inf)
    near = np.where(rng.random(300) < 0.5, far.argmin(axis=1), clustering.ASK)
    want = clustering.merge_small(np.arange(300), u @ u.T, np.ones(300), 0.6)
    near[far.min(axis=1) >= 0.6] = clustering.ASK
    assert clustering.merge_on(u.copy(), np.ones(300), near, 0.6).tolist() == want.tolist() and len(set(want.tolist())) < 150


def test_the_first_of_columns_equal_to_twelve_digits_is_nearest():
    alike = np.array([[0.5, 0.7, 0.7 + 1e-15, 0.7 - 1e-15], [0.1, 0.2, 0.3, 0.3], [0.0, 0.0, 0.0, 0.0], [0.9, 0.9 + 3e-12, 0.9, 0.2]])
    row, column, dist = clustering.least(alike, 0.9)
    assert (row.tolist(), column.tolist(), dist.tolist()) == ([0, 1, 3], [1, 2, 1], [0.3, 0.7, round(0.1 - 3e-12, 12)])
