"""Repeated passages of several lengths against brute force, and the sorted order of windows."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from themeloom.llm import suffixdedup


def repetitive(seed, n=40):
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("ab \x00é") for _ in range(rng.randint(20, 400))) for _ in range(8)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(pieces)[rng.randint(0, 60) :] + "".join(rng.choice("xy") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(0, 6)))
        rows.append((i * 2, text))
    return [*rows, (100, "a" * 900), (101, "a" * 1000), (102, "b" * 60 + "a" * 120), (103, ""), (104, None)]


def plain(rows, length):
    want, seen = {}, set()
    for i, t in sorted(rows):
        raw, mine = (t or "").encode(), set()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            mine.add(raw[p : p + length])
            if raw[p : p + length] in seen:
                gone[p : p + length] = True
        seen |= mine
        rest = bytes(np.frombuffer(raw, np.uint8)[~gone])
        want[i] = (len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(rest).hexdigest())
    return want


@pytest.mark.parametrize(("length", "group"), [(50, 3000), (84, 3000), (300, 10**7), (12, 3000)])
def test_any_length(spark, monkeypatch, length, group):
    monkeypatch.setattr(suffixdedup, "GROUP_BYTES", group)
    monkeypatch.setattr(suffixdedup, "SORTED", 500)
    rows = repetitive(length)
    got = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), length).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == plain(rows, length)


@pytest.mark.parametrize("length", [20, 50, 100])
def test_windows_in_corpus_order(length):
    rows = [(i, t) for i, t in repetitive(9) if t]
    flat = np.frombuffer(b"".join(t.encode() for _, t in rows), np.uint8)
    base = np.concatenate([[0], np.cumsum([len(t.encode()) for _, t in rows])])
    at, many, trigger, _, lead = suffixdedup.phrases(flat, base, length)
    for one in np.unique(trigger)[:40]:
        own = np.flatnonzero(trigger == one)
        text = np.append(flat, np.zeros(length, np.uint8))
        order, new = suffixdedup._classes(text, at[own], lead[own], many[own], length)
        windows = [flat[p + o : p + o + length].tobytes() for p, n in zip(at[own], many[own], strict=True) for o in range(n)]
        held = [windows[k] for k in order]
        assert held == sorted(windows)
        assert new.tolist() == [k == 0 or held[k] != held[k - 1] for k in range(len(held))]


def test_a_phrase_travels_whole():
    frame = pd.DataFrame({"doc_id": [1, 2], "_order": [0, 0], "text": ["abc" * 40, "abc" * 41]})
    parse = suffixdedup.Parse(frame, 50, 3)
    assert (parse.lead >= 0).all() and (parse.lead <= 30).all() and int(parse.many.sum()) == 120 - 49 + 123 - 49
