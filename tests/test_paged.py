"""The paged feed through Spark: pushed cutoffs and countries, and a stream that asks for no page twice."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import fake_feed
from themeloom.sources import paged


def _days(n, first=30):
    return [(f"r{k}", f"2024-01-{first - k:02d}T00:00:00") for k in range(n)]


def _reader(spark, kind, path, **options):
    paged.register(spark)
    held = getattr(spark, kind).format("paged_feed").option("client", "tests.fake_feed:pages").option("args", json.dumps({"path": str(path)}))
    for k, v in options.items():
        held = held.option(k, v)
    return held.load()


def test_pushed_cutoff_leaves_later_pages_unasked(spark, tmp_path):
    fake_feed.lay_out(tmp_path, us=_days(20), gb=_days(20))
    rows = _reader(spark, "read", tmp_path, countries="us,gb")
    assert rows.count() == 40
    (tmp_path / "asked").write_text("")
    got = rows.where(F.col("date") >= F.lit(datetime(2024, 1, 26))).collect()
    assert sorted((r.country, r.seq, r.id) for r in got) == [(c, k, f"r{k}") for c in ("gb", "us") for k in range(5)]
    assert sorted(fake_feed.asked(tmp_path)) == ["gb 3", "gb None", "us 3", "us None"]


def test_pushed_countries_and_other_filters(spark, tmp_path):
    fake_feed.lay_out(tmp_path, us=_days(4), gb=_days(4))
    rows = _reader(spark, "read", tmp_path, countries="us,gb")
    got = rows.where("country = 'gb' and id <> 'r1' and seq < 3").collect()
    assert sorted(r.id for r in got) == ["r0", "r2"]
    assert {a.split()[0] for a in fake_feed.asked(tmp_path)} == {"gb"}
    assert rows.where("country in ('fr')").count() == 0


def test_option_cutoff_cap_and_null_dates(spark, tmp_path):
    fake_feed.lay_out(tmp_path, us=[("a", "2024-01-05T00:00:00"), ("b", None), ("c", "2023-12-01T00:00:00"), ("d", "2024-01-04T00:00:00")], gb=_days(9), fr=[])
    got = _reader(spark, "read", tmp_path, countries="us,gb,fr", cutoff="2024-01-01", cap="4").collect()
    assert sorted((r.country, r.id) for r in got) == [("gb", "r0"), ("gb", "r1"), ("gb", "r2"), ("gb", "r3"), ("us", "a"), ("us", "b")]
    assert {r.date for r in got if r.id == "b"} == {None}
    strict = _reader(spark, "read", tmp_path, countries="us").where(F.col("date") > F.lit(datetime(2024, 1, 4)))
    assert [r.id for r in strict.collect()] == ["a"]


@pytest.mark.parametrize("failing", [None, 1])
def test_stream_asks_for_no_page_twice(spark, tmp_path, failing):
    """Every row once, and every page asked for once: through a failed batch, and after restarts."""
    fake_feed.lay_out(tmp_path, us=_days(11), gb=_days(4))
    options = {"countries": "us,gb", "log": str(tmp_path / "log"), "cutoff": "2024-01-22"}
    out, broken = str(tmp_path / "out"), []

    def put(batch, number):
        batch = batch.persist()
        batch.count()
        if number == failing and not broken:
            broken.append(number)
            raise RuntimeError("lost after the pages were read")
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        batch.unpersist()

    def run():
        stream = _reader(spark, "readStream", tmp_path, **options)
        query = stream.writeStream.foreachBatch(put).option("checkpointLocation", str(tmp_path / "check")).start()
        try:
            query.processAllAvailable()
        except Exception as error:
            assert "lost after" in str(error)
        finally:
            query.stop()

    for _ in range(3):
        run()
    got = sorted((r.country, r.seq, r.id) for r in spark.read.parquet(out).collect())
    assert got == sorted([("us", k, f"r{k}") for k in range(9)] + [("gb", k, f"r{k}") for k in range(4)])
    asked = fake_feed.asked(tmp_path)
    assert sorted(asked) == sorted(["us None", "us 3", "us 6", "us 9", "gb None", "gb 3"])
    assert bool(broken) == (failing is not None)
    assert {len(list((tmp_path / "log" / c).iterdir())) for c in ("us", "gb")} == {1}  # committed pages are gone but for the newest
