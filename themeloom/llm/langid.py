"""Language identification: scripts narrow the candidates, Viterbi over word scores labels spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import U64, mix, small_batches, spans

#: Unicode ranges of scripts (first and last code point).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}
OTHER = len(SCRIPTS)
#: Labelled documents that the word model is fitted on: about SAMPLE are drawn by a hash, but of each language at least
#: about LEAST (all, if it has fewer).
SAMPLE, LEAST = 20_000, 500
#: Hashed features of each order (character 1-, 2-, 3- and 4-grams of a word with its edges).
ORDERS, BUCKETS = 4, 1 << 16
#: Log-odds that a change of language inside a text has to make good.
SWITCH = 12.0

_tables: tuple | None = None


def _code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: its lower case, whether it is a letter, its script."""
    global _tables
    if _tables is None:
        lower, letter = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
        for c in range(0x32000):
            x = chr(c)
            if x.isalpha():
                letter[c] = True
                if len(y := x.lower()) == 1:
                    lower[c] = ord(y)
        script = np.full(0x110000, OTHER, np.int8)
        for k, ranges in enumerate(SCRIPTS.values()):
            for a, b in ranges:
                script[a : b + 1] = k
        _tables = lower, letter, script
    return _tables


def _word_features(texts: list[str]) -> tuple:
    """Word spans of texts that are joined by line feeds, and hashed n-gram buckets of every letter."""
    lower, letter, script = _code_tables()
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = lower[codes]
    is_letter = letter[codes]
    start, end = spans(is_letter)
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, start, "right")
    # Letters with one edge mark on both sides of every word, so that no n-gram leaves its word.
    at = np.flatnonzero(is_letter)
    lead = np.repeat(np.arange(len(start)), end - start) * 2 + 1
    padded = np.zeros(len(at) + 2 * len(start), U64)
    padded[np.arange(len(at)) + lead] = codes[at]
    first = start_of = np.concatenate([[0], np.cumsum(end - start + 2)])[:-1]
    return codes, start, end, doc, padded, first, start_of, script


def _buckets(padded: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram of each order that ends at each place, as of the padded letters."""
    out, h = [], np.zeros(len(padded), U64)
    for n in range(ORDERS):
        shifted = np.zeros(len(padded), U64)
        shifted[n:] = padded[: len(padded) - n] + U64(1)
        h = h + mix(shifted * U64(0x9E3779B97F4A7C15) + U64(n + 1))
        out.append((mix(h) & U64(BUCKETS - 1)).astype(np.int64))
    return out


def _valid(padded: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Where an n-gram of each order lies inside one word with its edges and holds a letter."""
    place = np.arange(len(padded)) - np.repeat(first, np.diff(np.append(first, len(padded))))
    inner = padded > 0
    return [inner, *((place >= n) & (inner | (n > 1)) & (place > 0) for n in range(1, ORDERS))]


def fit(labelled: DataFrame, sample: int = SAMPLE) -> dict:
    """Naive Bayes tables of hashed character n-grams from labelled(id, text, lang), nulls apart.

    About `sample` rows are used, drawn by a hash, and about LEAST of each language that this would give fewer
    (all, if it has no more), so that each language of a row with a letter is learned. Spark counts their n-grams,
    and what comes to the driver has languages * ORDERS * BUCKETS numbers at most.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.where("text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}"))
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    n = sum(many.values())
    if n > sample:
        share = {k: min(1.0, max(sample / n, LEAST / c)) for k, c in many.items()}
        cut = labelled.sparkSession.createDataFrame([(k, int(x * (1 << 30))) for k, x in share.items()], "lang string, cut long")
        drawn = F.pmod(F.xxhash64("id", "text", F.lit("langid")), F.lit(1 << 30))
        rows = rows.join(F.broadcast(cut), "lang").where(drawn < F.col("cut"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, part in frame.groupby("lang"):
                texts = part["text"].tolist()
                for at in range(0, len(texts), 100):
                    codes, start, _, _, padded, first, _, script = _word_features(texts[at : at + 100])
                    if not len(start):
                        continue
                    table = held.setdefault(lang, np.zeros((ORDERS, BUCKETS), np.int64))
                    for k, (b, ok) in enumerate(zip(_buckets(padded), _valid(padded, first), strict=True)):
                        table[k] += np.bincount(b[ok], minlength=BUCKETS)
                    seen = scripts.setdefault(lang, np.zeros(OTHER + 1, np.int64))
                    seen += np.bincount(script[padded[padded > 0].astype(np.int64)], minlength=OTHER + 1)
        for lang, table in held.items():
            order, bucket = np.nonzero(table)
            yield pd.DataFrame({"lang": lang, "k": order * BUCKETS + bucket, "n": table[order, bucket]})
            yield pd.DataFrame({"lang": lang, "k": -1 - np.arange(OTHER + 1), "n": scripts[lang]})

    counts = rows.select("text", "lang").mapInPandas(run, "lang string, k long, n long").groupBy("lang", "k").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.full((ORDERS * BUCKETS, len(languages)), 0.5, np.float64)
    scripts = np.zeros((OTHER + 1, len(languages)))
    for j, lang in enumerate(languages):
        part = counts[counts["lang"] == lang]
        inside = part["k"] >= 0
        table[part["k"][inside].to_numpy(), j] += part["n"][inside].to_numpy()
        scripts[-1 - part["k"][~inside].to_numpy(), j] = part["n"][~inside].to_numpy()
    table = table.reshape(ORDERS, BUCKETS, len(languages))
    scores = np.log(table / table.sum(axis=1, keepdims=True))
    if languages:
        scores -= scores.mean(axis=2, keepdims=True)
    allowed = scripts >= 0.001 * np.maximum(1, scripts.sum(axis=0))
    prior = max(languages, key=many.__getitem__, default=None)
    return {"languages": languages, "scores": (scores / ORDERS).astype(np.float32), "allowed": allowed, "prior": prior}


def viterbi(scores: np.ndarray, fresh: np.ndarray, penalty: float, block: int = 256) -> np.ndarray:
    """The best label of each word; changing labels costs `penalty`, but nothing where a text is `fresh`.

    The words of all texts form one chain, which is cut into blocks that advance together: first the best
    value of every (label on entry, label on exit) of each block, then the labels on entry, then the paths.
    """
    n, k = scores.shape
    if not n or k == 1:
        return np.zeros(n, np.int64)
    block = min(block, n)
    m = -(-n // block)
    s = np.zeros((m * block, k), np.float32)
    s[:n] = scores
    s = s.reshape(m, block, k)
    cost = np.full(m * block, penalty, np.float32)
    cost[:n][fresh] = 0
    cost = cost.reshape(m, block)
    gain = np.where(np.eye(k, dtype=bool), 0, -np.float32(np.inf))[None].repeat(m, 0).astype(np.float32)
    for t in range(block):  # gain[b, i, j]: best value that ends in j, entering from label i
        gain = np.maximum(gain, gain.max(axis=2, keepdims=True) - cost[:, t, None, None]) + s[:, t, None, :]
    entry = np.zeros((m, k), np.float32)
    for b in range(1, m):
        v = (entry[b - 1][:, None] + gain[b - 1]).max(axis=0)
        entry[b] = v - v.max()
    kind = np.int16 if k <= 1 << 15 else np.int32
    v, back = entry, np.zeros((block, m, k), kind)
    own = np.arange(k, dtype=kind)
    for t in range(block):
        top = v.argmax(axis=1)
        moved = v[np.arange(m), top] - cost[:, t]
        back[t] = np.where(v >= moved[:, None], own, top[:, None])
        v = np.maximum(v, moved[:, None]) + s[:, t]
    reach = np.tile(own, (m, 1))
    for t in range(block - 1, -1, -1):  # label on entry of a block for each label on exit
        reach = np.take_along_axis(back[t].astype(np.int64), reach, axis=1)
    last = np.zeros(m, np.int64)
    last[m - 1] = int(v[m - 1].argmax())
    for b in range(m - 1, 0, -1):
        last[b - 1] = reach[b, last[b]]
    out, now = np.zeros((m, block), np.int64), last
    for t in range(block - 1, -1, -1):
        out[:, t] = now
        now = back[t][np.arange(m), now]
    return out.reshape(-1)[:n]


def label_words(model: dict, texts: list[str], penalty: float = SWITCH) -> tuple:
    """(document, start, end, language number, scored) of each word of texts; start and end are code points."""
    codes, start, end, doc, padded, first, _, script = _word_features(texts)
    k = len(model["languages"])
    if not len(start) or not k:
        return doc, start, end, np.zeros(len(start), np.int64), np.zeros(len(start), bool)
    total = np.zeros((len(padded), k), np.float32)
    for order, (b, ok) in enumerate(zip(_buckets(padded), _valid(padded, first), strict=True)):
        total += np.where(ok[:, None], model["scores"][order][b], np.float32(0))
    word = np.add.reduceat(total, first, axis=0)
    usable = model["allowed"][script[codes[start]]]
    scored = usable.any(axis=1)
    word = np.where(usable, word, word.min(axis=1, keepdims=True) - penalty)
    word[~scored] = 0
    fresh = np.concatenate([[True], doc[1:] != doc[:-1]])
    base = np.cumsum([0] + [len(t) + 1 for t in texts])[doc]
    return doc, start - base, end - base, viterbi(word, fresh, penalty), scored


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", penalty: float = SWITCH, keep: tuple[str, ...] = (), guess: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, spans) and the columns `keep` for each row of docs.

    spans: the runs of words of one language, with first and last code point (end exclusive). lang_pred is
    the language with the most letters, ties to the first in alphabet order, `und` for null texts and texts
    without a letter; score is its share of all letters, 0 for `und`. Words in scripts of none of the
    learned languages count against the score. A text with words in such scripts only is `und`, or with `guess`
    a single span of the language of most labelled rows, with score 0. With no language learned all is `und`.
    Repeated rows are judged alike; ids and other columns are not looked at, nulls in them stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [F.col(c) for c in keep]
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("_text"), *kept)
    extra = [f for f in source.schema if f.name not in ("doc_id", "_text")]
    schema = "doc_id bigint, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>"
    schema += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in extra)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def some(texts: list[str]) -> list[tuple]:
        held = shared.value
        names = held["languages"]
        doc, start, end, lang, scored = label_words(held, texts, penalty)
        out = []
        cut = np.searchsorted(doc, np.arange(len(texts) + 1))
        for d in range(len(texts)):
            a, b = cut[d], cut[d + 1]
            letters = (end[a:b] - start[a:b]).astype(np.int64)
            if a == b or not names or not scored[a:b].any():
                if guess and a < b and names:
                    out.append((held["prior"], 0.0, [{"start": int(start[a]), "end": int(end[b - 1]), "lang": held["prior"]}]))
                else:
                    out.append(("und", 0.0, []))
                continue
            good = scored[a:b]
            mass = np.bincount(lang[a:b][good], weights=letters[good], minlength=len(names))
            top = int(mass.argmax())
            change = np.flatnonzero(np.diff(lang[a:b])) + 1
            firsts, lasts = np.concatenate([[0], change]) + a, np.concatenate([change, [b - a]]) + a - 1
            runs = [{"start": int(start[x]), "end": int(end[y]), "lang": names[lang[x]]} for x, y in zip(firsts, lasts, strict=True)]
            out.append((names[top], float(mass[top] / letters.sum()), runs))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, at = [x or "" for x in batch.column(1).to_pylist()], [], 0
            while at < len(texts):
                size, stop = len(texts[at]), at + 1
                while stop < len(texts) and size + len(texts[stop]) < 300_000:
                    size += len(texts[stop])
                    stop += 1
                rows += some(texts[at:stop])
                at = stop
            a, b, c = zip(*rows, strict=True) if rows else ([], [], [])
            held = [batch.column(0), pa.array(list(a), pa.string()), pa.array(list(b), pa.float64()), pa.array(list(c), kind)]
            yield pa.RecordBatch.from_arrays([*held, *(batch.column(i) for i in range(2, batch.num_columns))], names=["doc_id", "lang_pred", "score", "spans", *batch.schema.names[2:]])

    return source.mapInArrow(run, schema)


def training_rows(docs: DataFrame, is_training: Column) -> DataFrame:
    return docs.where(is_training).select(F.col("doc_id").alias("id"), "text", "lang")
