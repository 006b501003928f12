"""Edge rows, golden numbers and failures of the engine's operators."""

import datetime as dt
import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from themeloom.functions import text as tx
from themeloom.operators import clustering, extraction, feed, matching, report, sampling, themes
from themeloom.plans import session
from themeloom.sources import jsonl, paged
from themeloom.streaming import ingest


def test_strip_and_coalesce(spark):
    rows = spark.createDataFrame([("\t x  ", "", "2"), ("　", None, None), (None, "1", "2")], "t string, a string, b string")
    got = rows.select(tx.strip(F.col("t")), tx.first_truthy(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("x", "2"), ("", ""), ("", "1")]


def test_take_while_is_not_a_filter(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    rows = spark.createDataFrame([("f", 1, day(9)), ("f", 2, day(5)), ("f", 3, day(4)), ("f", 4, day(9))], "feed string, seq int, ts timestamp")
    assert [r.seq for r in feed.take_while(rows, F.lit(day(5)), "feed").orderBy("seq").collect()] == [1, 2]


def test_take_while_ignores_skipped_rows(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    rows = spark.createDataFrame([("f", 1, day(4), None), ("f", 2, day(9), "a")], "feed string, seq int, ts timestamp, id string")
    assert feed.take_while(rows, F.lit(day(5)), "feed", counts=F.col("id").isNotNull()).count() == 2


def test_language_rule(spark):
    rows = spark.createDataFrame([("en", 0.1), ("de", 0.49), ("de", 0.5), (None, 0.9)], "lang string, confidence double")
    got = feed.split_by_language(rows, "en").collect()
    assert [r.kept for r in got] == [True, True, False, False]
    assert got[3].detected_language == "unknown" and got[3].confidence == 0.0


def test_allocation_uses_doubles(spark):
    pool = {1: 42, 2: 9, 3: 726, 4: 268, 5: 250}
    rows = spark.createDataFrame([("p", k, n) for k, n in pool.items()], "platform string, rating int, pool bigint")
    got = {r.rating: r.n for r in sampling.allocate(rows, 500).collect()}
    assert got == {1: 16, 2: 4, 3: 280, 4: 103, 5: 97}


def test_short_stratum(spark):
    rows = spark.createDataFrame([(i, 1) for i in range(3)], "review_id int, rating int")
    with pytest.raises(ValueError):
        sampling.fixed(rows, {1: 5})
    assert sampling.fixed(rows, {1: 5}, strict=False).count() == 3


def test_unknown_label_is_an_error(spark):
    rows = spark.createDataFrame([("t", "grave", "other")], "theme string, severity string, feature_area string")
    with pytest.raises(PySparkException):
        themes.components(rows, ["theme"]).collect()


def test_published_scores(spark):
    rows = [("app crashes", 101, 2.87, 1.0), ("ads", 316, 2.40, 0.5), ("small", 9, 3.0, 1.0)]
    frame = spark.createDataFrame(rows, "theme string, size bigint, severity_mean double, fit_mean double")
    got = {r.theme: r for r in themes.score(frame).collect()}
    assert set(got) == {"app crashes", "ads"}
    assert got["ads"].freq_norm == pytest.approx(1.0)
    assert got["app crashes"].sev_part == pytest.approx(0.4 * 2.87 / 3)
    assert themes.score(frame.where("size < 10")).count() == 0


def test_published_skews(spark):
    rows = [("app crashes", 17, 9), ("playback", 16, 2), ("ads", 49, 48), ("performance", 5, 0), ("few", 2, 2)]
    frame = spark.createDataFrame(rows, "theme string, a bigint, i bigint").withColumns({"n_a": F.lit(318), "n_i": F.lit(180)})
    got = {r.theme: r.skew for r in themes.platform_skew(frame).collect()}
    assert got == {"app crashes": "~ even (Android 1.1x)", "playback": "Android 4.5x", "ads": "iOS 1.7x", "performance": "Android only"}


def test_explode_and_cap(spark):
    issue = lambda t, h="h": {"theme": t, "severity": "low", "sentiment": None, "feature_area": "other", "segment_hint": h}
    rows = spark.createDataFrame(
        [("r", [issue(" a "), issue(" "), issue(None), issue("b", None), issue("c")])],
        f"review_id string, issues {extraction.ISSUES}",
    )
    got = themes.explode_issues(themes.cap_issues(rows)).collect()
    assert [(r.theme, r.segment_hint, r.issue_pos) for r in got] == [("a", "h", 0), ("b", "", 3)]


def test_matcher_ties_and_nulls(spark):
    rows = spark.createDataFrame(
        [(1, [("other", "low"), ("other", "low")], [("other", "low"), ("other", "low")]), (2, [(None, "high")], [(None, "low")])],
        f"k int, model {matching.ISSUE}, gold {matching.ISSUE}",
    )
    got = {r.k: r for r in matching.match(rows).collect()}
    assert [(m.mi, m.gi) for m in got[1].matches] == [(1, 1), (0, 0)]
    assert [(m.score, m.mi, m.gi) for m in got[2].matches] == [(2.0, 0, 0)]


def test_report_rounds_half_to_even():
    m = {"n_matched": 35, "n_model": 56, "area_strict": 20, "area_parent": 29, "severity_exact": 17, "severity_within_one": 29}
    out = report.render({(True, True): 35, (True, False): 3, (False, False): 10}, m)
    assert "35/56 | 62%" in out and "45/48 = 94%" in out and "17/35 | 49%" in out
    assert report.half_even(0, 0) == "n/a"


def test_average_linkage(spark):
    rows = [(0, 0, [1.0, 0.0]), (0, 1, [2.0, 0.0]), (0, 2, [1.0, 0.1]), (0, 3, [0.0, 1.0]), (1, 4, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "part int, id int, v array<double>")
    got = {r.id: r.cluster for r in clustering.average_linkage(frame, 0.5, "part", "id", "v").collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4}
    with pytest.raises(PySparkException):
        clustering.average_linkage(spark.createDataFrame([(0, 0, [0.0, 0.0])], frame.schema), 0.5, "part", "id", "v").collect()


def test_retry():
    tries, waits = [], []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError("Connection reset")
        return [{"theme": "x"}]

    issues, status, log = extraction.with_retry(flaky, wait=waits.append)
    assert (issues, status, len(waits)) == ([{"theme": "x"}], "ok", 2)
    assert [(a["attempt"], a["kind"], a["waited"]) for a in log] == [(1, "server", 0.0), (2, "server", waits[0]), (3, "ok", waits[1])]

    def capped():
        raise RuntimeError("tokens per day exceeded, rate limit")

    _, status, log = extraction.with_retry(capped, wait=waits.append)
    assert status == "daily_cap" and [a["kind"] for a in log] == ["daily_cap"]
    assert extraction.with_retry(flaky, stopped=lambda: True) == (None, "daily_cap", [])
    with pytest.raises(ValueError):
        extraction.backend("none")


def test_jsonl(spark, tmp_path):
    schema = "review_id string, rating int"
    (tmp_path / "a.json").write_text('{"review_id": "é", "rating": null}\n\n{"review_id": "b", "rating": 2}\n')
    rows = jsonl.read(spark, str(tmp_path / "a.json"), schema)
    jsonl.write(rows.coalesce(1), str(tmp_path / "out"))
    lines = [json.loads(x) for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    assert {"review_id": "é", "rating": None} in lines and len(lines) == 2
    (tmp_path / "b.json").write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        jsonl.read(spark, str(tmp_path / "b.json"), schema).collect()
    assert jsonl.read(spark, str(tmp_path / "none"), schema, missing_ok=True).count() == 0


def test_stream_is_idempotent(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "1.json").write_text('{"review_id": "a", "timestamp": "2024-01-01T00:00:00Z"}\n{"review_id": "a", "timestamp": "2024-01-01T00:00:01Z"}\n')
    for k in (1, 2):
        stream = ingest.reviews_stream(spark, str(src), "review_id string, timestamp timestamp")
        ingest.append_new(stream, out, str(tmp_path / f"check{k}")).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_waits_grow_and_end():
    held = list(extraction.waits(6, 1.0, 4.0))
    assert len(held) == 6 and all(0.5 * min(4, 2**k) <= w <= 1.5 * min(4, 2**k) for k, w in enumerate(held))
    said = ("tokens per day exceeded", "rate limit reached", "no such field")
    assert [extraction.outcome(RuntimeError(x)) for x in said] == ["daily_cap", "rate_limit", "failed"]


def test_tools_and_schema():
    schema = extraction.json_schema()["properties"]["issues"]
    assert schema["maxItems"] == 4 and schema["items"]["properties"]["feature_area"]["enum"] == themes.AREAS and set(schema["items"]["required"]) == set(extraction.DECLARATION.names)
    assert extraction.nested_tool("t")["function"]["parameters"] == extraction.flat_tool("t")["input_schema"]


def pages(country, token):
    """A feed of three pages of four reviews, a day apart, newest first."""
    at = int(token or 0)
    rows = [{"id": f"{country}{at * 4 + k}", "rating": 3, "content": "x", "date": datetime(2024, 1, 20 - at * 4 - k)} for k in range(4)]
    return rows, str(at + 1) if at < 2 else None


@pytest.mark.parametrize(("options", "most"), [({}, 12), ({"cap": "5"}, 5), ({"cutoff": "2024-01-14"}, 7)])
def test_paged_feed_stops(options, most):
    reader = paged.PagedReader({"client": f"{__name__}:pages", "countries": "us, gb", **options})
    got = [list(reader.read(p)) for p in reader.partitions()]
    assert [len(x) for x in got] == [most, most] and [r[0] for r in got[0]] == list(range(most)) and {r[-1] for r in got[1]} == {"gb"}


def test_guards(spark):
    model = spark.createDataFrame([(1,), (2,), (2,)], "review_id int")
    ids, only_model, only_gold = matching.common_ids(model, model.where("review_id = 2").union(spark.createDataFrame([(9,)], "review_id int")))
    assert [r[0] for r in ids.collect()] == [2] and (only_model, only_gold) == (1, 1)
    with pytest.raises(ValueError):
        matching.common_ids(model, model.where("false"))


@pytest.mark.parametrize("threshold", [0.55, 0.9])
def test_average_linkage_against_plain(spark, threshold):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(40, 6)) + 2 * rng.integers(0, 2, size=(40, 6))
    rows = [(i % 2, i, v[i].tolist()) for i in range(40)] + [(0, 40, (2 * v[0]).tolist())]
    want = {}
    for part in (0, 1):
        ids = [r[1] for r in rows if r[0] == part]
        u = {i: np.array(rows[i][2]) / np.linalg.norm(rows[i][2]) for i in ids}
        groups = [[i] for i in ids]
        while len(groups) > 1:
            d, a, b = min((1 - np.mean([u[i] @ u[j] for i in x for j in y]), a, b) for a, x in enumerate(groups) for b, y in enumerate(groups) if a < b)
            if d >= threshold:
                break
            groups[a] += groups.pop(b)
        want |= {i: min(g) for g in groups for i in g}
    frame = spark.createDataFrame(rows, "part int, id int, v array<double>")
    for small in (clustering.SMALL, 0):
        got = {r.id: r.cluster for r in clustering.average_linkage(frame, threshold, "part", "id", "v", small=small).collect()}
        assert got == want


def test_settled_tables_outlive_what_was_written_before(spark):
    first = session.materialise(spark.range(3))
    since = session.written()
    middle = session.materialise(spark.range(5))
    out = session.settle(middle.selectExpr("id * 2 AS id"), since)
    assert sorted(r.id for r in out.collect()) == [0, 2, 4, 6, 8] and first.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        middle.collect()
    assert session.written() == since + 1


def test_stream_repeats_across_days(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "1.json").write_text(
        "".join(f'{{"review_id": "{i}", "timestamp": "2024-01-0{d}T23:59:0{d}Z"}}\n' for i, d in (("a", 1), ("a", 2), ("b", 2), ("c", 5))),
    )
    for k in (1, 2, 3):
        stream = ingest.reviews_stream(spark, str(src), "review_id string, timestamp timestamp", lateness="9 days")
        ingest.append_new(stream, out, str(tmp_path / f"check{k}")).awaitTermination()
    assert sorted(r.review_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_split_sink_writes_each_row_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, True, "é"), (2, False, None), (3, None, "x"), (4, True, None)], "id int, kept boolean, text string")
    kept, dropped = str(tmp_path / "kept"), str(tmp_path / "dropped")
    for _ in range(2):  # again: overwritten
        jsonl.write_split(rows, "kept", kept, dropped)
    assert sorted(tuple(r) for r in jsonl.read(spark, kept, "id int, text string").collect()) == [(1, "é"), (4, None)]
    assert sorted(r.id for r in jsonl.read(spark, dropped, "id int, text string").collect()) == [2, 3]


def test_prompt_names_no_complaint():
    words = set(extraction.PROMPT.lower().replace(".", "").replace(",", "").split())
    assert "issues" in words and not words & {"crash", "ads", "login", "playlist", "slow", "bug", *themes.AREAS}
    assert extraction.flat_tool("t")["description"] == extraction.nested_tool("t")["function"]["description"] == extraction.PROMPT
