"""Periodic runs, SimHash links and hard negatives against plain versions."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from themeloom.llm import negatives, periodic, queries, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^\x20\x09-\x0D]+"


def _documents(spark, tmp_path, rows):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(3).write.parquet(path)
    return str(tmp_path)


# --- periodic runs


def plain_runs(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_op11(doc, text):
    words = re.findall(WORD, text or "")
    n = len(words)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-math.ldexp(r[1], 0) / r[2], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


def _repetitive(rng):
    out = []
    while len(out) < rng.randint(0, 80):
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 5))]
        out += unit * rng.randint(1, 7)
    return rng.choice([" ", "\t ", "\n"]).join(out)


def test_periodic_runs_equal_plain(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, _repetitive(rng)) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "a " * 5), (304, "a\x0ba\x0ca\ra a a"), (305, "  " * 9), (None, "x y " * 8), (7, "z " * 20), (7, "z " * 20)]
    got = queries.op11_periodic_runs(spark, _documents(spark, tmp_path, rows))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((plain_op11(*r) for r in rows), key=key)


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (4, 2), (5, 3)])
def test_runs_of_words_that_share_a_grammar(least, exponent):
    rng = random.Random(least)
    for _ in range(60):
        texts = [_repetitive(rng).encode() for _ in range(rng.randint(1, 9))]
        for text, (n, runs, _) in zip(texts, periodic._some(texts, least, exponent), strict=True):
            assert n == len(text.split())
            assert list(map(tuple, runs.tolist())) == plain_runs(text.split(), least, exponent)


def test_extensions_of_long_repeats():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 50, 3000)
    symbols = np.concatenate([part, [99], part, [98], np.full(2000, 5), part[:1500]])
    levels = periodic.grammar(symbols)
    a, b = rng.integers(0, len(symbols), (2, 500))
    a, b = np.minimum(a, b), np.maximum(a, b) + (a == b)
    a, b = np.concatenate([a, [0, 10]]), np.concatenate([b, [3001, 3011]])
    ok = b < len(symbols)
    a, b = a[ok], b[ok]

    def plain(x, y):
        n = 0
        while y + n < len(symbols) and symbols[x + n] == symbols[y + n]:
            n += 1
        return n

    assert periodic.extensions(levels, a, b).tolist() == [plain(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def test_periodic_runs_of_a_long_text_and_other_columns(spark):
    text = " ".join(str(i) for i in range(40_000)) + " p q r" * 30_000 + " end" + " s" * 50_000
    docs = spark.createDataFrame([(1 << 62 | 1, text, "n", None), (None, "b", "m", 4)], "doc_id long, text string, runs_ string, `n words` long")
    held = {r["doc_id"]: r for r in periodic.periodic_runs(docs, keep=("runs_", "n words")).collect()}
    assert [tuple(r) for r in held[1 << 62 | 1]["runs"]] == [(40_000, 90_000, 3), (130_001, 50_000, 1)]
    assert held[None]["n words"] == 4 and held[1 << 62 | 1]["n words"] is None
    assert held[1 << 62 | 1]["collapsed"].endswith(" 39999 p q r end s")
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


# --- SimHash


def plain_fingerprint(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(WORD, lower)
    size = min(3, len(words))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    """The smallest node reachable from each."""
    out = {}
    for n in sorted(nodes):
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += [y for y in nodes if y not in out and linked(x, y)]
    return out


def test_simhash_equals_plain(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(0, 240, 4):
        words = [rng.choice(["Alpha", "beta", "gamma", "delta", "Ärger", "x1"]) + str(rng.randint(0, 9)) for _ in range(rng.randint(1, 90))]
        for k in range(4):
            new = list(words)
            for _ in range(k):
                new[rng.randrange(len(new))] = rng.choice("uvw")
            rows.append((i + k, rng.choice([" ", "\n\t"]).join(new).upper() if k == 3 else " ".join(new)))
    rows += [(1000, None), (1001, ""), (1002, " \t"), (None, rows[0][1]), (900, rows[0][1]), (900, rows[8][1]), (901, "one two"), (902, "ONE\ttwo"), (903, "one")]
    rows += [(2000 + i, "the same text of many copies again") for i in range(200)]
    got = sorted(map(tuple, queries.op12_simhash_dedup(spark, _documents(spark, tmp_path, rows)).collect()), key=str)
    prints = {t: plain_fingerprint(t) for _, t in rows}
    of = plain_components(set(prints.values()), lambda x, y: (x ^ y).bit_count() <= 2)
    least = {}
    for i, t in rows:
        if i is not None:
            least[of[prints[t]]] = min(i, least.get(of[prints[t]], i))
    want = [(i, f"{prints[t]:016x}", None if i is None else least[of[prints[t]]]) for i, t in rows]
    assert got == sorted(want, key=str)
    assert len({r[2] for r in want}) < len(want) - 200


@pytest.mark.parametrize("most", [1, 4, 64])
def test_simhash_links_lose_none_where_values_are_hot(spark, most):
    """Dense fingerprints about a few centres: every bucket is hot, and each pair within two bits is found, no other."""
    rng = random.Random(9)
    prints = {0, (1 << 64) - 1}
    for centre in [rng.getrandbits(64) for _ in range(4)]:
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.choice([rng.randrange(64), rng.randrange(12)])
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), most).distinct()
    want = {(a, b) for a in signed for b in signed if a < b and (a % (1 << 64) ^ b % (1 << 64)).bit_count() <= 2}
    assert {tuple(r) for r in got.collect()} == want and len(want) > 500


def test_simhash_of_no_rows(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


# --- hard negatives


def plain_negatives(rows, every=50, few=5, top=3):
    rows = [(i, y, np.array(v, dtype=object)) for i, y, v in rows]
    out = []
    for i, y, v in rows:
        if i % every:
            continue
        scored = [(-int((v * w).sum()), j, z) for j, z, w in rows if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == y)[:few]:
            fit = sorted((t, k) for t, k, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s)[:top]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize(("n", "codes"), [(2, 1), (16, 2), (64, 4), (70, 3)])
def test_hard_negatives_equal_plain(spark, n, codes, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 2000)
    rng = np.random.default_rng(n)
    centre = rng.standard_normal((3, n))
    rows = [(i, int(rng.integers(0, 4)), np.floor(60 * (rng.standard_normal(n) + centre[i % 3])).astype(int).tolist()) for i in range(400)]
    rows += [(400, 1, rows[0][2]), (401, 2, rows[0][2]), (402, 2, [0] * n), (450, 3, [0] * n), (451, 3, rows[0][2][:-1]), (500, 0, rows[0][2][:-1])]
    held = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(3)
    got = negatives.hard_negatives(held, F.col("id") % 50 == 0, codes=codes)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_bounds_hold_and_rule_rows_out():
    rng = np.random.default_rng(0)
    v = np.floor(256 * rng.standard_normal((500, 64)) / 8).astype(np.int64)
    v[200:] = v[:300] + rng.integers(-9, 9, (300, 64))
    anchors = negatives.Anchors(np.arange(50), np.zeros(50), v[:50])

    class Held:
        codes, length, parts, left = negatives.encode(v)

    a, r = np.divmod(np.arange(50 * 500), 500)
    score = (v[a] * v[r]).sum(axis=1)
    for low, high in ((40_000, np.inf), (-5_000, 5_000)):
        x, y = negatives.possible(anchors, Held, a, r, np.full(len(a), float(low)), np.full(len(a), float(high)))
        kept = set((x * 500 + y).tolist())
        assert kept >= set(np.flatnonzero((score >= low) & (score <= high)).tolist())
        assert len(kept) < (1500 if low > 0 else 24_500)


def test_hard_negatives_of_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 10)), [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    odd = [(None, 1, [1.0] * 8), (1000, None, [1.0] * 8), (1050, 1, None), (1100, 1, []), (1150, 1, [None] + [1.0] * 7), (1200, 1, [float("nan")] * 8), (1250, 1, [float("inf")] * 8)]
    for name, held in (("a", rows), ("b", rows + odd), ("none", odd)):
        spark.createDataFrame(held, "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / name / "embeddings.parquet"))
    a, b, none = (queries.op13_hard_negatives(spark, str(tmp_path / x)) for x in ("a", "b", "none"))
    want = sorted(map(tuple, a.collect()))
    assert want and want == sorted(map(tuple, b.collect()))
    assert none.count() == 0
    path = str(tmp_path / "b" / "embeddings.parquet" / "*.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    sql = db.execute(f"SELECT {', '.join(a.columns)} FROM ({queries.oracle_sql()['op13_hard_negatives']})").fetchall()
    assert sorted(sql) == want


def test_rows_that_repeat_an_id_and_large_components(spark):
    rows = [(0, 1, [3, 4]), (1, 1, [3, 4]), (1, 1, [3, 4]), (2, 2, [2, 3]), (2, 0, [2, 2])]
    held = spark.createDataFrame(rows, "id long, label long, vector array<long>")
    assert sorted(map(tuple, negatives.hard_negatives(held, F.col("id") == 0).collect())) == [(0, 1, 1, 2, 25, 18)]
    with pytest.raises(Exception, match="too large"):
        negatives.hard_negatives(spark.createDataFrame([(0, 1, [1 << 33])], "id long, label long, vector array<long>"), F.col("id") == 0)
