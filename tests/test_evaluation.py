"""The published evaluation, rebuilt from its labels, and whole match records."""

import pytest
from pyspark.sql import functions as F

from themeloom.operators import matching, report

#: The published labels, as number of reviews | model issues | gold issues, each area/severity. Their order
#: in a review was not published; with the matched one last, which wins ties, they give the published pairs.
LABELS = """
10 | |
1 | core_listening/high |
1 | monetization/high |
1 | other/medium |
1 | account/high | account/high
2 | account/high account/high | account/high
2 | account/high | account/low
1 | downloads/high downloads/high other/medium | account/medium
1 | core_listening/high | core_listening/high
1 | stability/high | core_listening/high
1 | stability/high core_listening/high | core_listening/high
1 | stability/high monetization/high | core_listening/high
4 | core_listening/high | core_listening/low
1 | core_listening/high core_listening/medium | core_listening/low
1 | discovery/medium | core_listening/low
1 | core_listening/high | core_listening/medium
1 | other/medium | discovery/low
1 | account/high account/high monetization/high | monetization/high
1 | core_listening/high | monetization/high
1 | monetization/high | monetization/high
4 | monetization/medium | monetization/high
1 | discovery/high discovery/high | monetization/medium
1 | downloads/high | other/high
1 | downloads/high downloads/medium other/high | other/high
1 | stability/high | other/high
1 | stability/high core_listening/high monetization/medium stability/high | other/high
1 | stability/high core_listening/high stability/high | other/high
1 | stability/high stability/high | other/high
1 | downloads/medium | other/low
1 | downloads/high | other/medium
1 | core_listening/medium | social/low
"""
MODEL = "array<struct<theme:string,feature_area:string,severity:string>>"
GOLD = "array<struct<desc:string,feature_area:string,severity:string>>"


def _issues(said, name):
    return [{name: f"{name} {k}", "feature_area": x.partition("/")[0], "severity": x.partition("/")[2]} for k, x in enumerate(said.split())]


@pytest.fixture
def reviews(spark):
    rows = []
    for line in LABELS.strip().split("\n"):
        n, model, gold = (x.strip() for x in line.split("|"))
        rows += [(len(rows) + k, "text", None, _issues(model, "theme"), _issues(gold, "desc")) for k in range(int(n))]
    return spark.createDataFrame(rows, f"review_id int, review_text string, has_issue boolean, model {MODEL}, gold {GOLD}")


def test_published_evaluation(reviews):
    matched = matching.match(reviews)
    cells = matching.confusion(reviews, F.size("gold") > 0, F.size("model") > 0).collect()
    held = {(r.model_has, r.gold_has): r.n for r in cells}
    assert held == {(True, True): 35, (True, False): 3, (False, True): 0, (False, False): 10}
    m = matching.metrics(matched).first().asDict()
    assert m == {"n_model": 56, "n_matched": 35, "area_strict": 20, "area_parent": 29, "severity_exact": 17, "severity_within_one": 29}
    said = report.render(held, m)
    for part in ("45/48 = 94%", "35/56 | 62%", "20/35 | 57%", "29/35 | 83%", "17/35 | 49%"):
        assert part in said


def test_whole_records(spark, reviews):
    out = matching.match_record(matching.match(reviews)).collect()
    assert len(out) == 48 and sum(len(r.matches) for r in out) == 35
    assert sum(len(r.unmatched_model_issues) for r in out) == 21 and not any(r.unmatched_gold_issues for r in out)
    assert sum(p.feature_area_match for r in out for p in r.matches) == 20 and sum(p.severity_match for r in out for p in r.matches) == 17
    rows = [
        (1, None, False, [("a", None, "low"), ("b", "other", "high")], [("c", None, "high"), ("d", "social", "low"), ("e", "other", "high")]),
        (2, "t", None, [], [("f", "other", "low")]),
        (3, "t", None, [], []),
        (4, "t", True, [("g", "other", None)], []),
    ]
    got = {r.review_id: r for r in matching.match_record(matching.match(spark.createDataFrame(rows, reviews.schema))).collect()}
    one = got[1]
    assert (one.review_text, one.gold_has_issue, one.model_has_issue) == ("", False, True)
    pairs = [(p.model.theme, p.gold.desc, p.feature_area_match, p.severity_match) for p in one.matches]
    assert pairs == [("b", "e", True, True), ("a", "c", True, False)]
    assert [tuple(x) for x in one.unmatched_gold_issues] == [("d", "social", "low")] and one.unmatched_model_issues == []
    assert [(r.gold_has_issue, r.model_has_issue) for r in (got[2], got[3], got[4])] == [(True, False), (False, False), (True, True)]
    assert [tuple(x) for x in got[4].unmatched_model_issues] == [("g", "other", None)]
