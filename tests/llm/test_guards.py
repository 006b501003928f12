"""Wide ids beside nulls, carried columns, many languages, other vocabularies, long windows, repeated lines."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from themeloom.llm import langid, licences, neardup, packing, suffixdedup, tokencount

WIDE = [(1 << 62) + 1, (1 << 62) + 3, None]


def test_packing_keeps_wide_ids_beside_nulls(spark):
    docs = spark.createDataFrame([(i, "some words to pack " * 3) for i in WIDE], "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert {r.doc_id for r in got} == set(WIDE) and len({r.sequence_id for r in got}) == 1
    assert [r.offset for r in sorted(got, key=lambda r: r.offset)] == [0, got[0].length, 2 * got[0].length]
    none = packing.pack_documents(docs.limit(0), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert none.count() == 0 and none.schema["doc_id"].dataType.simpleString() == "bigint"


def test_packing_of_repeated_ids(spark):
    docs = spark.createDataFrame([(5, "one two three"), (5, "one two three"), (5, None)], "doc_id long, text string")
    got = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(5, 1), (5, 4), (5, 4)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 3


def test_suffix_stage_carries_columns_unchanged(spark):
    """The pipeline's suffix stage against a plain cut, with nullable numbers and clashing names."""
    part = "this passage of well over fifty bytes stands in several documents, "
    rows = [(i, f"own {i} " + part * (i % 3) + f"tail {i}", WIDE[i % 3], i / 3 if i % 2 else None, f"k{i}", 7) for i in range(30)]
    rows += [(WIDE[0], part, WIDE[1], None, None, None), (None, part, WIDE[0], 0.5, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept long, _row double, _group string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.cut_repeated_passages(spark, docs, "").collect()}
    seen = set()
    for i, text, *rest in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        mine = {raw[p : p + 50] for p in range(len(raw) - 49)} if i is not None else set()
        for p in range(len(raw) - 49) if i is not None else ():
            if raw[p : p + 50] in seen:
                gone[p : p + 50] = True
        seen |= mine
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode()
        assert tuple(got[i]) == (i, kept, *rest[:3], len(kept))
    assert got.keys() == {r[0] for r in rows}
    assert corpus_pipeline.cut_repeated_passages(spark, docs.limit(0), "").count() == 0


def test_long_windows(spark):
    rng = np.random.default_rng(3)
    part = "".join(map(chr, rng.integers(97, 123, 20_000)))
    rows = [(1, "a" + part + "end"), (2, "bb" + part), (3, part[:5_100] + "zz"), (4, part[:4_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixdedup.remove_repeats(docs, 5_000).collect()
    want = {1: (0, rows[0][1]), 2: (20_000, "bb"), 3: (5_100, "zz"), 4: (0, rows[3][1])}
    assert {r.doc_id: (r.n_removed, r.kept) for r in got} == want
    assert all(r.kept_sha256 == hashlib.sha256(want[r.doc_id][1].encode()).hexdigest() for r in got)
    for length in (0, 70_000):
        with pytest.raises(ValueError, match="length"):
            suffixdedup.remove_repeats(docs, length)


def plain_viterbi(scores, fresh, penalty):
    back, v = [], scores[0].astype(float)
    for t in range(1, len(scores)):
        cost = 0 if fresh[t] else penalty
        top = int(v.argmax())
        back.append(np.where(v >= v[top] - cost, np.arange(len(v)), top))
        v = np.maximum(v, v[top] - cost) + scores[t]
    return float(v.max())


@pytest.mark.parametrize("k", [127, 128, 200, 300])
def test_many_languages(k):
    rng = np.random.default_rng(k)
    scores = rng.standard_normal((90, k)).astype(np.float32)
    fresh = rng.random(90) < 0.1
    got = langid.viterbi(scores, fresh, 2.0, block=32)
    assert got.min() >= 0 and got.max() < k
    moved = (got[1:] != got[:-1]) & ~fresh[1:]
    assert abs(float(scores[np.arange(90), got].sum()) - 2.0 * moved.sum() - plain_viterbi(scores, fresh, 2.0)) < 1e-3


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_of_either_vocabulary(spark, monkeypatch, name):
    """Long texts go through splicing on Spark; a vocabulary that keeps white space is counted as the library does."""
    path = public_tokenizers.path(name)
    rng = np.random.default_rng(1)
    words = ["it's", "naïve", "日本語", "x", "12", "don't", "...", "supercalifragilistic", "<|endoftext|>", " "]
    texts = [None, "", "  a  b\t\n c ", "a" * 40_000, "it's  fine here", " " * 50_000 + "x"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(n)) for n in (10, 3000, 20_000)]
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokencount.token_counts(docs, path).collect()}
    assert got == {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in enumerate(texts)}


def test_boundaries_of_tokenizers():
    assert tokencount.boundaries(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))) == "dropped"
    held = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokencount.boundaries(held) in ("leads", "unknown")
    held.pre_tokenizer = None
    assert tokencount.boundaries(held) == "unknown"


def test_repeated_lines_do_not_swallow_the_sample(spark):
    docs = spark.createDataFrame([(f"boiler {i % 8}\nline {i} of its own\nboiler {(i + 1) % 8}",) for i in range(3000)], "text string")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).select(F.xxhash64("line").alias("h"), "line")
    got = licences._least_lines(lines, 1000)
    want = [r["line"] for r in lines.distinct().orderBy("h", "line").limit(1000).collect()]
    assert got == want and len(set(got)) == 1000
    assert len(licences._least_lines(lines, 5000)) == 3008
    assert licences._least_lines(lines.limit(0), 10) == []


def test_the_greatest_text_speaks_for_a_repeated_id(spark):
    a, b = ("one two three four five six seven eight nine", "zebra yak xerus wolf viper unicorn tapir snake rat")
    rows = [(1, a), (2, a), (2, b), (3, b), (4, b), (4, ""), (5, None), (5, None), (None, a), (6, "q w e r t y"), (6, "q w e r t y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(str, map(tuple, neardup.near_duplicates(docs, 5, 80).collect())))
    sizes = {a: 5, b: 5, "": 0, None: 0, "q w e r t y": 2}
    component = {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6, None: None}
    want = [(i, sizes[t], component[i], i is None or i == component[i]) for i, t in rows]
    assert got == sorted(map(str, want))
