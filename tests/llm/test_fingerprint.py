"""Order, ranges and likeness of fingerprints against brute force on awkward ids."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from themeloom.llm import fingerprint

LOW, HIGH = -(1 << 63), (1 << 63) - 1


def edit(t, after):
    half = len(t) // 2
    return t[: len(t) - half] + after[:half]


@pytest.mark.parametrize("cuts", [fingerprint.CUTS])
def test_wide_null_and_repeated_ids(spark, monkeypatch, cuts):
    monkeypatch.setattr(fingerprint, "RANGE", 8)
    monkeypatch.setattr(fingerprint, "TASK", 16)
    monkeypatch.setattr(fingerprint, "CUTS", cuts)
    ids = [LOW, HIGH, HIGH - 1, 0, *range(100, 160), 1 << 40, None, None, *[777] * 60]
    rows = [(i, f"text {k} of {i} with some words {k % 7}", k) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `range` bigint")
    held, n = fingerprint.placed(docs.select("doc_id", "text"))
    many = [r["count"] for r in held.groupBy("range").count().collect()]
    assert n == len(rows) == sum(many) and (cuts == 5 or max(many) <= 20)
    order = [r["text"] for r in held.orderBy("at", "tie", "text").collect()]
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in fingerprint.compare_with_edits(docs).collect())
    id_of = {t: i for i, t, _ in rows}
    want = Counter((id_of[t], len(t), hashlib.sha256(edit(t, a).encode()).hexdigest()) for t, a in zip(order, order[1:] + order[:1], strict=True))
    assert got == want


def test_likeness_is_generalised_jaccard(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{i // 2}x{x}" for x in rng.zipf(1.5, 150) % 300)) for i in range(400)]  # each two have words of their own
    got = fingerprint.compare_with_edits(spark.createDataFrame(rows, "doc_id bigint, text string")).toPandas().set_index("doc_id")
    gaps = []
    for i, t in rows[::2]:
        after = rows[i + 1][1]
        for other, column in ((after, "near_next"), (edit(t, after), "near_edited")):
            a, b = Counter(t.split()), Counter(other.split())
            gaps.append(got[column][i] - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(gaps)) < 0.012 and np.std(gaps) < 0.075
