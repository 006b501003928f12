"""The corpus operators against brute force on small fixtures with nulls, blanks, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from themeloom.llm import decontam, fingerprint, langid, licences, neardup, packing, suffixdedup, tokenbin, tokencount, tokens, toxicity
from themeloom.llm import queries as registered

SF = "/root/testdata/sf0.001"
RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(80)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 120))) for _ in range(n // 3)]
    out = list(base)
    while len(out) < n:
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    out += [None, "", "  \n ", "a", "A", base[0], base[0].upper(), "x" * 3000]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "en" if i % 2 else None, "s", i, i, i) for i, t in corpus()]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n bigint, g bigint, `range` bigint").cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def groups(sets, percent):
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, empty, k):
    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if x]
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in texts(docs).items()}
    want = groups(sets, 80)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs, shingle=k).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_null_id_and_repeats(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 1)]


def test_mixed_bucket_pairs_are_not_lost():
    rng = np.random.default_rng(0)
    pool = neardup.mix(np.arange(1, 4000, dtype=np.uint64))
    core = pool[:200]
    sets = [np.unique(np.concatenate([rng.choice(core, 190, replace=False), rng.choice(pool[200:], 10)])) for _ in range(40)]
    lows = [neardup.minima(s) for s in sets]
    x = {
        "rep": np.arange(40), "label": np.arange(40), "n": np.array([len(s) for s in sets]), "block": np.zeros(40),
        "sig": np.stack([neardup.pack(v) for v in lows]), "long": np.stack([neardup.pack(neardup.minima(s, neardup.LONG), 1) for s in sets]),
        "bands": np.stack([neardup.band_keys(v) for v in lows]),
    }
    found = set()
    for band in range(neardup.BANDS):
        found |= set(zip(*map(list, neardup._bucket_pairs(x, band, False, 80)), strict=True))
    for i in range(40):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both / (len(sets[i]) + len(sets[j]) - both) >= 0.82:
                assert (j, i) in found


@pytest.mark.parametrize("group", [4000, 10**7])
def test_repeated_passages(docs, empty, monkeypatch, group):
    monkeypatch.setattr(suffixdedup, "GROUP_BYTES", group)
    want, seen = {}, set()
    for i, t in sorted(texts(docs).items()):
        raw, mine = t.encode(), set()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            mine.add(raw[p : p + 50])
            if raw[p : p + 50] in seen:
                gone[p : p + 50] = True
        seen |= mine
        rest = bytes(np.frombuffer(raw, np.uint8)[~gone])
        want[i] = (len(raw), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(rest).hexdigest())
    got = suffixdedup.remove_repeats(docs, keep=("n", "g", "source"))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == want
    assert suffixdedup.remove_repeats(empty).count() == 0


def test_repeats_of_one_id_and_null_ids_stay(spark):
    t = "abcdefghij" * 9
    frame = spark.createDataFrame([(None, t), (5, t), (5, t), (7, t)], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffixdedup.remove_repeats(frame).collect())
    assert got == [(0, 0), (5, 0), (5, 0), (7, 90)]


def test_token_counts(docs, empty):
    library = Tokenizer.from_file(WORDS)
    got = {r.doc_id: r for r in tokencount.token_counts(docs, WORDS).collect()}
    for i, t in texts(docs).items():
        assert got[i].n_tokens == len(library.encode(t, add_special_tokens=False).ids)
        assert got[i].n_bytes == len(t.encode())
    assert tokencount.token_counts(empty, WORDS).count() == 0


@pytest.mark.parametrize("text", ["ab <|endoftext|>c " * 400, "a" * 5000, "é́ x\x1cy　z " * 300, "word\n" * 999, ""])
def test_splice_count(text):
    library = Tokenizer.from_file(WORDS)
    encode = lambda x: library.encode(x, add_special_tokens=False).offsets
    assert tokencount.splice_count(text, encode, chunk=97, overlap=3) == len(encode(text))
    assert sum(len(encode(w)) for w in tokencount.words(text)) == len(encode(text))


def test_packing(docs, empty):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in texts(docs).items()}
    rows = packing.pack_documents(docs, RANKS, most=256).toPandas()
    for i, part in rows.groupby("doc_id"):
        part = part.sort_values("piece")
        assert part["length"].sum() == len(ids[i]) and (part["start"] == part["length"].cumsum() - part["length"]).all()
        assert all(zlib.crc32(ids[i][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in part.itertuples())
    for _, part in rows.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["length"].sum() <= 256 and (part["offset"] == part["length"].cumsum() - part["length"]).all()
    assert rows["sequence_id"].nunique() <= rows["length"].sum() / 256 * 1.05 + 2
    assert packing.pack_documents(empty, RANKS).count() == 0


@pytest.mark.parametrize("text", ["a" + " " * 1_000_001 + "b", "\n" * 1_000_001, "x é" + "\t\r\n \u2003" * 250_000 + "<|endoftext|> y", " " * 1_000_001 + "\n'll" + "\n" * 100_000 + " z"])
def test_ids_of_long_runs(text):
    assert tokens.rank_ids(RANKS, text).tolist() == Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text).ids


def test_local_search_empties_bins():
    lengths = [6, 4, 5, 3, 2]
    bins = packing.local_search([[0], [1], [2], [3, 4]], lengths, 10)
    assert sorted(i for b in bins for i in b) == [0, 1, 2, 3, 4] and len(bins) == 2
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 60))]
        start = packing.best_fit(sizes, 20)
        done = packing.local_search(start, sizes, 20)
        assert sorted(i for b in done for i in b) == list(range(len(sizes))) and len(done) <= len(start)
        assert all(sum(sizes[i] for i in b) <= 20 for b in done)


def test_token_matrix_round_trip(docs, empty):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = tokenbin.packed_rows(docs, RANKS, most=64)
    back = {r.doc_id: r.ids for r in tokenbin.read_documents(rows).collect()}
    assert back == {i: [*library.encode(t, add_special_tokens=False).ids, 50256] for i, t in texts(docs).items()}
    for r in rows.collect():
        place = np.frombuffer(r.position_ids, "<u4")
        assert all(place[a:b].tolist() == list(range(b - a)) for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]))
        assert sum(r.loss_mask) == r.n_tokens == r.cu_seqlens[-1]
    assert tokenbin.packed_rows(empty, RANKS).count() == 0


def test_room_tree():
    rng, tree, held = random.Random(3), tokenbin.RoomTree(50), Counter()
    for _ in range(500):
        room = rng.randint(0, 50)
        by = -1 if held[room] and rng.random() < 0.5 else 1
        held[room] += by
        tree.add(room, by)
        n = rng.randint(0, 50)
        assert tree.least(n) == min((r for r in held if held[r] and r >= n), default=None)


def test_viterbi_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n, k = rng.integers(1, 40), rng.integers(2, 5)
        s, fresh = rng.normal(size=(n, k)).astype(np.float32) * 3, rng.random(n) < 0.1
        fresh[0] = True
        path = langid.viterbi(s, fresh, 2.0, block=int(rng.integers(1, 9)))
        v = np.zeros(k)
        for t in range(n):
            v = np.maximum(v, v.max() - (0 if fresh[t] else 2.0)) + s[t]
        value = sum(s[t, path[t]] - (0 if fresh[t] or path[t] == path[t - 1] else 2.0) for t in range(n))
        assert value == pytest.approx(v.max(), abs=1e-3)


def test_language_id(spark):
    out = registered.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.95 and out["score"].between(0, 1).all()


def test_language_spans_and_edges(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("привет мир", "ru")] * 5)]
    model = langid.fit(spark.createDataFrame(rows, "id bigint, text string, lang string"))
    asked = [(1, "the cat and the dog and the cat der hund und die katze und der hund", "x"), (2, None, "y"), (3, "12 !", None), (4, "привет", "z"), (5, "ελ", "z")]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(asked, "doc_id bigint, text string, score string"), model, penalty=2.0).collect()}
    assert [x.lang for x in got[1].spans] == ["en", "de"] and got[1].spans[0].start == 0
    assert got[2].lang_pred == got[3].lang_pred == got[5].lang_pred == "und" and got[4].lang_pred == "ru"
    none = langid.fit(spark.createDataFrame([], "id bigint, text string, lang string"))
    assert langid.identify(spark.createDataFrame(asked, "doc_id bigint, text string, l string"), none).first().lang_pred == "und"


def test_rare_languages_and_unlearned_scripts(spark):
    rows = [(None if i % 2 else i, f"the cat and the dog {i}", "en") for i in range(3000)] + [(None, "καλημέρα κόσμε", "el"), (9001, "добрый день", "ru"), (9002, "12", "xx")]
    model = langid.fit(spark.createDataFrame(rows, "id bigint, text string, lang string"), sample=300)
    assert model["languages"] == ["el", "en", "ru"]
    asked = spark.createDataFrame([(1, "κόσμε"), (2, "день"), (3, "สวัสดี ครับ"), (4, "12"), (5, None)], "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score, len(r.spans)) for r in langid.identify(asked, model, guess=True).collect()}
    assert got == {1: ("el", 1.0, 1), 2: ("ru", 1.0, 1), 3: ("en", 0.0, 1), 4: ("und", 0.0, 0), 5: ("und", 0.0, 0)}


def test_toxicity(spark):
    rng = random.Random(4)
    common, bad = ["the", "of", "and", "in", "to", "was", "for", "that"], ["idiot", "moron", "scum"]
    rows = []
    for i in range(600):
        words = [rng.choice(common) for _ in range(40)]
        if toxic := i % 4 == 0:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "id bigint, text string, y int")
    model = toxicity.fit(frame.where("id < 500"))
    asked = frame.where("id >= 500").union(spark.createDataFrame([(1000, None, 0), (1001, "", 0)], frame.schema)).withColumnRenamed("id", "doc_id")
    got = toxicity.score(asked, model, keep=("y",)).toPandas()
    assert ((got["score"] >= 0.5) == (got["y"] == 1)).mean() > 0.95 and got["score"].between(0, 1).all()
    nothing = toxicity.fit(frame.where("false"))
    assert toxicity.score(asked, nothing).count() == len(got)


def test_fingerprints(docs, empty):
    rows = fingerprint.compare_with_edits(docs).toPandas().sort_values("doc_id", ignore_index=True)
    held = [t for _, t in sorted(texts(docs).items())]
    bag = lambda t: Counter(t.lower().split())
    gaps = []
    for k, (t, after) in enumerate(zip(held, held[1:] + held[:1], strict=True)):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert rows["edited_sha256"][k] == hashlib.sha256(edited.encode()).hexdigest() and rows["n_chars"][k] == len(t)
        a, c = bag(t), bag(edited)
        gaps.append((sum((a & c).values()) / sum((a | c).values()) if a or c else 1.0) - rows["near_edited"][k])
    assert abs(np.mean(gaps)) < 0.04 and np.std(gaps) < 0.1
    same = defaultdict(set)
    for t, f in zip(held, rows["fingerprint"], strict=True):
        same[t].add(f)
    assert all(len(f) == 1 for f in same.values())
    assert fingerprint.compare_with_edits(empty).count() == 0


def test_fingerprints_of_long_texts(spark):
    side = {c: [f"{c}{i}" for i in range(5000)] for c in "abc"}
    rows = [(1, " ".join(side["a"])), (2, " ".join(side["b"])), (3, " ".join(side["b"] + side["c"]))]
    got = {r.doc_id: r for r in fingerprint.compare_with_edits(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].near_next == got[3].near_next == 0 and abs(got[2].near_next - 0.5) < 0.25


def test_fingerprint_of_one_row(spark):
    got = fingerprint.compare_with_edits(spark.createDataFrame([(4, "ab cd")], "doc_id bigint, text string")).collect()
    assert len(got) == 1 and got[0].near_next == 1.0


def test_decontamination(spark, docs, empty):
    held = texts(docs)
    items = [(k, " ".join(held[i].split()[3:40])) for k, i in enumerate(sorted(held)) if len(held[i].split()) > 50][:8]
    items += [(50, "A"), (51, None), (52, "never seen before at all here"), (53, items[0][1].upper() + " extra")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    words = lambda t: re.sub(r"[^\w]+|_", " ", (t or "").lower()).split()

    def shingles(w, k):
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    want = set()
    for i, t in held.items():
        for k, q in items:
            w = words(q)
            own = shingles(w, min(5, len(w))) if w else set()
            if own and len(own & shingles(words(t), min(5, len(w)))) >= 0.8 * len(own):
                want.add((i, k))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    assert got == want and want
    assert decontam.contaminated(empty, bench).count() == 0 and decontam.contaminated(docs, bench.where("false")).count() == 0


def test_licences(spark, empty):
    plain = [f"ordinary words about thing number {i} and nothing else" for i in range(300)]
    rows = [(i, t) for i, t in enumerate(plain)] + [
        (1000, "intro\n\nReleased under the MIT License.\n\nend"), (1001, "x\nLicensed under the Apache License, Version 2.0."), (1002, None), (1003, ""),
        (1004, "Licensed under CC BY-NC 4.0."), (1005, "This work is licensed under the GNU General Public License, version 3."),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in licences.scan(frame, licences.fit(frame)).collect()}
    assert [got[i].licences for i in range(1000, 1006)] == [["mit"], ["apache"], [], [], ["cc-by-nc"], ["gpl"]]
    assert sum(bool(got[i].licences) for i in range(300)) == 0 and (1, "mit") in [(f.paragraph, f.licence) for f in got[1000].found]
    assert licences.scan(empty, licences.fit(empty)).count() == 0
