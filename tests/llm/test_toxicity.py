"""Toxicity scores against a plain Kneser-Ney of the same definition, and both ways of looking evidence up."""

import random
import re
from collections import Counter, defaultdict
from math import log

import pytest

from themeloom.llm import toxicity


def rows_of(n, seed=6):
    rng = random.Random(seed)
    common, bad = [f"w{i}" for i in range(40)], ["idiot", "moron", "scum", "dumb head"]
    rows = []
    for i in range(n):
        words = [common[min(int(rng.expovariate(0.15)), 39)] for _ in range(rng.randint(1, 50))]
        if toxic := i % 5 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words) + 1), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def plain(rows, backoff=1.0):
    """A function of a text: its length-normalised log-likelihood ratio under both models, word by word."""
    grams = [set(), set()]
    for _, text, y in rows:
        words = ["", "", *re.findall(r"\w+", text.lower())]
        grams[y] |= set(zip(words, words[1:], words[2:], strict=False))
    n = [Counter((v, w) for _, v, w in g) for g in grams]
    c = [Counter(w for _, w in p) for p in n]
    both = Counter(w for _, w in set(n[0]) | set(n[1]))
    m = [Counter(), Counter()]
    for k in (0, 1):
        for (v, _), x in n[k].items():
            m[k][v] += x

    def kept(k, x, other, least, total):
        share = [t / sum(total) for t in total]
        owed = toxicity.ODDS * share[k] / (1 + (toxicity.ODDS - 1) * share[k])
        return max(0.0, x - max(least * share[k] / min(share), (x + other) * owed))

    t, tm = [sum(x.values()) for x in c], [sum(x.values()) for x in m]
    kw = [{w: kept(k, c[k][w], c[1 - k][w], toxicity.LEAST_WORD, t) for w in both} for k in (0, 1)]
    kp = [{p: kept(k, n[k][p], n[1 - k][p], toxicity.LEAST_PAIR, tm) for p in set(n[0]) | set(n[1])} for k in (0, 1)]
    rest = [1 - sum(kw[k].values()) / t[k] for k in (0, 1)]
    left = [defaultdict(float), defaultdict(float)]
    for k in (0, 1):
        for (v, _), x in kp[k].items():
            left[k][v] += x

    def likelihood(k, v, w):
        shared = (both[w] + 0.5) / (sum(both.values()) + 0.5 * (len(both) + 1))
        q = kw[k].get(w, 0) / t[k] + rest[k] * backoff * shared
        return kp[k].get((v, w), 0) / max(1, m[k][v]) + (1 - left[k][v] / m[k][v] if m[k][v] else 1) * q

    def ratio(text):
        words = ["", *re.findall(r"\w+", (text or "").lower())]
        held = [log(likelihood(1, v, w)) - log(likelihood(0, v, w)) for v, w in zip(words, words[1:], strict=False)]
        return sum(held) / max(1, len(held))

    return ratio


@pytest.mark.parametrize("bucket", [10_000_000, 400])
def test_ratios_are_those_of_the_definition(spark, monkeypatch, bucket):
    monkeypatch.setattr(toxicity, "BUCKET", bucket)
    monkeypatch.setattr(toxicity, "SLICE", bucket)
    monkeypatch.setattr(toxicity, "LEAST_PAIR", 4)
    rows = rows_of(400)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, y int").repartition(3)
    told, other = toxicity.evidence(frame)
    kinds = {r["kind"]: r["count"] for r in told.groupBy("kind").count().collect()}
    assert kinds[0] > 0 and kinds[1] > 0 and kinds[2] > 0
    asked = [*rows_of(60, seed=9), (900, None, 0), (901, "", 0), (902, " . ", 0), (903, "new words only", 0), (903, "new words only", 0), (904, "scum " * 5000, 1)]
    asked = spark.createDataFrame(asked, "doc_id bigint, _text string, y int")
    expected, damped = plain(rows), plain(rows, 0.5)
    texts = {r["doc_id"]: r["_text"] for r in asked.collect()}
    for few in (True, False):
        got = toxicity.ratios(asked, told, other, few).collect()
        assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in asked.collect())
        for r in got:
            assert r["ratio"] == pytest.approx(expected(texts[r["doc_id"]]), abs=1e-9)
            assert r["n_words"] == len(re.findall(r"\w+", texts[r["doc_id"]] or ""))
    assert max(abs(damped(x) - expected(x)) for x in texts.values()) > 0.01


def test_edges(spark):
    frame = spark.createDataFrame(rows_of(300), "id bigint, text string, y int")
    asked = spark.createDataFrame(
        [(1, "you idiot moron", "a", 1), (1, "you idiot moron", "a", 1), (None, None, None, 2), (5, "", "b", 3)],
        "doc_id bigint, text string, score string, ratio int",
    )
    model = toxicity.fit(frame)
    got = toxicity.score(asked, model, keep=()).collect()
    assert len(got) == 4 and len({r["score"] for r in got if r["doc_id"] == 1}) == 1 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(asked.where("false"), model).count() == 0
    nothing = toxicity.fit(frame.where("false"))
    assert toxicity.score(asked, nothing).count() == 4
    one_class = toxicity.fit(frame.where("y = 1"))
    assert toxicity.score(asked, one_class).count() == 4


def test_discounts_are_chosen_on_rows_that_the_counts_leave_out(spark):
    model = toxicity.fit(spark.createDataFrame(rows_of(900), "id long, text string, y int"))
    assert model["odds"] in (toxicity.ODDS, *toxicity.OTHER_ODDS) and model["multiple"] in (1, *toxicity.MULTIPLES)
    assert model["area"] > 0.95
    one = toxicity.fit(spark.createDataFrame([(i, "a b c", 0) for i in range(40)], "id long, text string, y int"))
    assert (one["odds"], one["multiple"]) == (toxicity.ODDS, 1)


def test_separation_and_calibration_of_bins():
    import numpy as np

    n = np.zeros((2, toxicity.BINS))
    n[0, [100, 200, 300]], n[1, [250, 400, 900]] = (5, 3, 1), (1, 4, 2)
    pairs = [(a > b) + 0.5 * (a == b) for a in np.repeat([250, 400, 900], [1, 4, 2]) for b in np.repeat([100, 200, 300], [5, 3, 1])]
    assert toxicity.separation(n) == pytest.approx(np.mean(pairs))
    x, p = toxicity.calibrate(n)
    bins = [round((v + toxicity.SPAN) / (2 * toxicity.SPAN) * toxicity.BINS - 0.5) for v in x]
    assert bins == [100, 200, 250, 300, 400, 900] and p == sorted(p)
    assert p[0] == p[1] == pytest.approx(0.05 / 8.5) and p[2] == p[3] == pytest.approx(1.05 / 2.5) and p[4] == pytest.approx(6.05 / 6.5)
    assert toxicity.calibrate(np.zeros((2, toxicity.BINS))) == ([0.0], [0.0])
