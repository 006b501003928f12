"""Extraction runs that are killed, capped and repeated: each review once, no call after a cap, counts equal the log."""

import os
import time

import pytest

from themeloom.operators import extraction, runs
from themeloom.sources.shared import Marker

ROWS = [(f"r{i}", f"t{i}") for i in range(60)]


def _backend(name, path, fails=lambda text, tries: None):
    """Registers a backend that notes each call in a file; fails(text, tries so far) may give an error."""

    def make():
        def call(text):
            tries = len(os.listdir(path)) and sum(x.startswith(f"{text}.") for x in os.listdir(path))
            with open(f"{path}/{text}.{time.time_ns()}", "w"):
                pass
            error = fails(text, tries)
            if error:
                raise RuntimeError(error)
            return [{"theme": text, "severity": "low", "sentiment": "neutral", "feature_area": "other", "segment_hint": ""}] * 6

        return call

    extraction.register(name, make)


def _calls(path):
    return sorted(x.partition(".")[0] for x in os.listdir(path))


@pytest.fixture
def calls(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path / "calls")


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame([*ROWS, ROWS[0], (None, "nobody's")], "review_id string, text string")


def test_each_review_once_and_only_failures_again(spark, tmp_path, calls, reviews):
    _backend("plain", calls, lambda t, _: "malformed" if t in ("t3", "t7") else None)
    path = str(tmp_path / "store")
    first = runs.run(reviews, path, "k", "plain", tasks=3, waves=4)
    assert (first.calls, first.done, first.failed, first.left, first.capped) == (60, 58, 2, 0, False)
    again = runs.run(reviews, path, "k", "plain", tasks=3, waves=2)
    assert (again.calls, again.done, again.failed) == (2, 0, 2)
    held = runs.results(spark, path, "k")
    assert sorted(r.review_id for r in held.collect()) == sorted(i for i, _ in ROWS)
    assert runs.cached(spark, path, "k").where("size(issues) = 4").count() == 58
    assert {(r.review_id, r.said) for r in runs.dead_letters(spark, path, "k").collect()} == {("r3", "malformed"), ("r7", "malformed")}
    assert runs.cached(spark, path, "other").count() == 0
    assert runs.run(reviews, path, "other", "plain", waves=1).calls == 60


@pytest.mark.parametrize("where", ["staging", "publishing"])
def test_a_killed_and_repeated_run_leaves_each_review_once(spark, tmp_path, calls, reviews, monkeypatch, where):
    _backend("killed", calls)
    path, publish, done = str(tmp_path / "store"), runs._publish, []

    def dies(*args):
        if len(done) == 1 and where == "publishing":
            done.append("killed")
            raise KeyboardInterrupt
        publish(*args)
        done.append(1)
        if len(done) == 2 and where == "staging":  # the next wave is staged in part only
            at, _ = runs._staged(path, "k")
            spark.createDataFrame([("r0", "x")], "review_id string, status string").write.parquet(f"{at}/part")
            raise KeyboardInterrupt

    monkeypatch.setattr(runs, "_publish", dies)
    with pytest.raises(KeyboardInterrupt):
        runs.run(reviews, path, "k", "killed", waves=4)
    assert 0 < runs.results(spark, path, "k").count() < 60
    monkeypatch.setattr(runs, "_publish", publish)
    runs.run(reviews, path, "k", "killed", waves=4)
    assert sorted(r.review_id for r in runs.results(spark, path, "k").collect()) == sorted(i for i, _ in ROWS)
    assert _calls(calls) == sorted(t for _, t in ROWS)  # what was staged whole is not called again


def test_after_a_cap_no_task_calls(spark, tmp_path, calls, reviews):
    def fails(text, _):
        time.sleep(0.05)
        return "tokens per day exceeded" if len(os.listdir(calls)) > 12 else None

    _backend("capped", calls, fails)
    path, tasks = str(tmp_path / "store"), 4
    report = runs.run(reviews, path, "k", "capped", tasks=tasks, waves=3)
    assert report.capped and report.done + report.left == 60 and report.calls == len(os.listdir(calls))
    assert 12 < report.calls <= 12 + tasks  # the calls that were under way
    held = runs.results(spark, path, "k")
    assert held.where("status = 'ok'").count() == report.done
    assert 12 - tasks < report.done <= 12
    _backend("capped", calls)
    again = runs.run(reviews, path, "k", "capped", tasks=tasks, waves=3)
    assert (again.calls, again.done, again.capped) == (60 - report.done, 60 - report.done, False)
    assert runs.cached(spark, path, "k").count() == 60


def test_counts_equal_the_attempt_log(spark, tmp_path, calls, reviews):
    def fails(text, tries):
        if text in ("t1", "t2", "t5") and tries < 2:
            return "429 too many requests" if tries else "Connection reset"
        return "503" if text == "t9" else None

    _backend("flaky", calls, fails)
    path = str(tmp_path / "store")
    report = runs.run(reviews, path, "k", "flaky", waves=2, retries=3, base=0.001, cap=0.002)
    log = runs.attempts(spark, path, "k").persist()
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds == {"ok": 59, "server": 7, "rate_limit": 3}
    assert (report.calls, report.retries, report.rate_limited, report.server, report.failed) == (69, 9, 3, 7, 1)
    events = runs.last_events(log, 4).collect()
    assert len(events) == 4 and [r.at for r in events] == sorted((r.at for r in events), reverse=True)
    assert min(r.at for r in events) >= sorted((r.at for r in log.where("kind <> 'ok'").collect()), reverse=True)[3]
    row = runs.throughput(log, 100).first()
    assert (row.done, row.calls) == (59, 69)
    assert row.reviews_per_second == pytest.approx(59 / row.seconds) and row.seconds_left == pytest.approx(41 * row.seconds / 59)
    assert runs.throughput(log.where("false"), 5).first().seconds_left is None


def test_wide_ids_and_wrong_schemas(spark, tmp_path, calls):
    _backend("wide", calls)
    rows = spark.createDataFrame([((1 << 62) + 1, "a"), ((1 << 62) + 3, "b"), (None, "c")], "review_id long, text string")
    path = str(tmp_path / "store")
    assert runs.run(rows, path, "k", "wide", waves=1).done == 2
    assert {r.review_id for r in runs.cached(spark, path, "k", "bigint").collect()} == {(1 << 62) + 1, (1 << 62) + 3}
    broken = tmp_path / "bad" / "results" / "cache_key=x" / "bucket=1"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("no such format")
    with pytest.raises(Exception, match="not a Parquet file"):
        runs.cached(spark, str(tmp_path / "bad"), "x").collect()
    marker = Marker(f"file:{tmp_path}/m/x")
    assert not marker.up()
    marker.put()
    assert marker.up()
    marker.clear()
    assert not marker.up()
