"""Toxicity by two class-conditional Kneser-Ney word models with a shared backoff.

The model of class c is p_c(w | v) = kept_c(v, w) / m_c(v) + rest_c(v) * q_c(w), q_c(w) = kept_c(w) / t_c + rest_c * s(w).
Counts are Kneser-Ney's: of a bigram the words that precede it (so a passage that is copied a thousand times counts
once), of a word the words that it follows; s is the share of the latter in both classes together, and shared by them.
kept is a count less its discount, rest what the discounts free for the backoff. A discount is at least LEAST_* contexts
(more in the larger class, by its size), and at least what the class would have of the counts at ODDS times its odds:
an expression speaks for a class only where it stands out from both classes together. Which of a few such numbers hold is
told by the part of the training rows that the counts leave out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import ALNUM, LOWER, U64, byte_values, mix, prefix, separated, slices, small_batches, span_hash, spans
from themeloom.plans.session import materialise

#: Contexts that a word and a bigram of the smaller class need at least to say anything, and the odds against the class's size:
#: where fit() begins. It then tries other odds, and with the best of these other multiples of both least numbers.
LEAST_WORD, LEAST_PAIR, ODDS = 4, 10, 3.0
OTHER_ODDS, MULTIPLES = (1.5, 6.0), (1 / 3, 3.0)
#: Every CALIBRATE-th labelled row (by a hash of its id) is left out of the counts and calibrates the score.
CALIBRATE = 4
#: Labels (a number and a class each), and rows of evidence, up to which they are broadcast; beyond, a shuffle joins them.
BROADCAST_ROWS = 2_000_000
#: Bytes of labelled text that are counted together in a task, before and after the shuffle.
SLICE, BUCKET = 8_000_000, 8_000_000
#: Bins of the normalised log-likelihood ratio, over -SPAN to SPAN, that calibration gathers.
BINS, SPAN = 4000, 2.0

_VALUES = byte_values(2)


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word and of the word before it (0 at the start of a text), and its text's number."""
    data, at = separated(LOWER[data], off)
    start, end = spans(ALNUM[data])
    word = span_hash(prefix(_VALUES[data]), start, end)
    doc = np.searchsorted(at, start, "right") - 1
    return word, _before(word, doc), doc


def _before(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    out = np.zeros(len(word), U64)
    out[1:] = np.where(doc[1:] == doc[:-1], word[:-1], U64(0))
    return out


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * U64(0x9E3779B97F4A7C15) + w)


def _packed(u: np.ndarray, v: np.ndarray, w: np.ndarray, y: np.ndarray) -> tuple[int, bytes]:
    """Trigrams and their classes as compressed places in the list of their words, behind the size of that."""
    words, place = np.unique(np.concatenate([u, v, w]), return_inverse=True)
    place = place.astype(np.uint32).view(np.uint8).reshape(-1, 4).T
    raw = np.array([len(words)], np.int64).tobytes() + words.tobytes() + place.tobytes() + y.astype(np.uint8).tobytes()
    return len(raw), pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    words, rest = raw[8 : 8 + 8 * n].view(U64), raw[8 + 8 * n :]
    m = len(rest) // 13
    place = np.ascontiguousarray(rest[: 12 * m].reshape(4, 3 * m).T).view(np.uint32).ravel()
    u, v, w = words[place].reshape(3, m)
    return u, v, w, rest[12 * m :]


def context_counts(labelled: DataFrame, least: float | None = None) -> DataFrame:
    """Counts of labelled(text, y): rows (v, w, n0, n1, n) of three kinds.

    With v null: n0, n1 and n words precede the word w in class 0, class 1 and either, in parts to be summed. With w null:
    m0 and m1 (in n0, n1) distinct pairs of neighbours surround the word v, in parts as well. Else: n0 and n1 words
    precede the bigram v, w; only bigrams that have more than `least` (LEAST_PAIR) in a class are listed.
    Tasks send their distinct trigrams, packed, to buckets by bigram: the bigrams of one word are dealt to as many
    buckets as its hash and B ** 0.75 allow, so that no word fills a task and few parts of its counts arise.
    """
    small_batches(labelled.sparkSession)
    least = LEAST_PAIR if least is None else least
    total = labelled.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    spread = max(1, round(buckets**0.75))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def sent() -> pa.RecordBatch:
            u, v, w, y = (np.concatenate([h[i] for h in held]) for i in range(4))
            _, one = np.unique(mix(_pair(v, w) + u) ^ y, return_index=True)
            u, v, w, y = u[one], v[one], w[one], y[one]
            bucket = ((mix(w) + mix(v) % U64(spread) * U64(0x9E3779B1)) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            found, first = np.unique(bucket[order], return_index=True)
            parts = [order[a:b] for a, b in zip(first, [*first[1:], len(order)], strict=True)]
            rows = [_packed(u[p], v[p], w[p], y[p]) for p in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array([n for n, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())],
                names=["bucket", "size", "payload"],
            )

        size = 0
        for batch in batches:
            y = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), np.int64)
            for i, _, data, off in slices(batch.column(0), 4 << 20):
                word, v, doc = _tokens(data, off)
                held.append((_before(v, doc), v, word, y[i + doc].astype(U64)))
                size += len(data)
                if size >= SLICE:
                    yield sent()
                    held, size = [], 0
        if held:
            yield sent()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        u, v, w, y = (np.concatenate(x) for x in zip(*[_unpacked(p, n) for p, n in zip(frame["payload"], frame["size"], strict=True)], strict=True))
        _, one = np.unique(mix(_pair(v, w) + u) ^ y.astype(U64), return_index=True)
        v, w, y = v[one], w[one], y[one]
        _, first, place = np.unique(_pair(v, w), return_index=True, return_inverse=True)
        n = np.stack([np.bincount(place[y == c], minlength=len(first)) for c in (0, 1)])
        v, w = v[first], w[first]
        out = []
        for key, each in ((w, [*(n > 0), np.ones(len(w), bool)]), (v, [*n, np.zeros(len(v))])):
            words, at = np.unique(key, return_inverse=True)
            sums = [np.bincount(at, weights=x, minlength=len(words)).astype(np.int64) for x in each]
            out.append(pd.DataFrame({"v" if key is v else "w": pd.array(words.view(np.int64), "Int64"), "n0": sums[0], "n1": sums[1], "n": sums[2]}))
        some = (n > least).any(axis=0)
        out.append(
            pd.DataFrame(
                {"v": pd.array(v[some].view(np.int64), "Int64"), "w": pd.array(w[some].view(np.int64), "Int64"), "n0": n[0][some], "n1": n[1][some], "n": 0},
            ),
        )
        return pd.concat(out, ignore_index=True)[["v", "w", "n0", "n1", "n"]]

    dealt = labelled.select("text", "y").mapInArrow(deal, "bucket bigint, size bigint, payload binary")
    return dealt.groupBy("bucket").applyInPandas(merge, "v bigint, w bigint, n0 bigint, n1 bigint, n bigint")


def _kept(n: Column, both: Column, least: float, share: float, least_share: float, odds: float) -> Column:
    """A count less its discount: at least `least` contexts by the size of the class, at least its share at `odds`."""
    owed = odds * share / (1 + (odds - 1) * share)
    return F.greatest(n - F.greatest(F.lit(least * share / least_share), both * owed), F.lit(0.0))


def evidence(labelled: DataFrame) -> tuple[DataFrame, float]:
    """evidence_of() the counts of labelled(text, y), with the numbers that fit() begins with."""
    return evidence_of(materialise(context_counts(labelled)), LEAST_WORD, LEAST_PAIR, ODDS)


def evidence_of(counts: DataFrame, least_word: float, least_pair: float, odds: float) -> tuple[DataFrame, float]:
    """What tells the classes of context_counts() apart: rows (kind, v, w, value), and the value of all other words.

    The log-likelihood ratio of a text is the sum, over its words, of the value for other words and of the values of
    the word (kind 0), of the word before (1) and of both as a bigram (2), 0 where there is none: where neither
    class keeps a count of its own, the shared backoff is a factor of both likelihoods and leaves the ratio.
    """
    by_word = counts.where("v is null").groupBy("w").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "n")])
    contexts = counts.where("w is null").groupBy("v").agg(F.sum("n0").alias("m0"), F.sum("n1").alias("m1"))
    all_words = counts.where("v is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0", "n1", "n")]).first()
    all_pairs = counts.where("w is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0", "n1")]).first()
    t, m = [max(1, all_words[f"n{c}"]) for c in (0, 1)], [max(1, all_pairs[f"n{c}"]) for c in (0, 1)]
    share, pair_share = ([x / sum(held) for x in held] for held in (t, m))

    kept = {f"k{c}": _kept(F.col(f"n{c}"), F.expr("n0 + n1"), least_word, share[c], min(share), odds) for c in (0, 1)}
    words = materialise(by_word.withColumns(kept))
    size = words.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(f"k{c}"), F.lit(0.0)).alias(f"k{c}") for c in (0, 1)]).first()
    rest = [max(1e-9, 1 - size[f"k{c}"] / t[c]) for c in (0, 1)]
    other = log(rest[1] / rest[0])
    shared = (F.col("n") + 0.5) / (all_words["n"] + 0.5 * (size["n"] + 1))
    q = [F.col(f"k{c}") / t[c] + rest[c] * shared for c in (0, 1)]
    own = words.where("k0 > 0 or k1 > 0").select(F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("v"), "w", (F.log(q[1] / q[0]) - other).alias("value"))

    pairs = counts.where("v is not null and w is not null").select("v", "w", "n0", "n1")
    pairs = pairs.withColumns({f"k{c}": _kept(F.col(f"n{c}"), F.expr("n0 + n1"), least_pair, pair_share[c], min(pair_share), odds) for c in (0, 1)})
    pairs = materialise(pairs.where("k0 > 0 or k1 > 0"))
    left = pairs.groupBy("v").agg(F.sum("k0").alias("s0"), F.sum("k1").alias("s1")).join(contexts.hint("merge"), "v")
    rests = [F.greatest(1 - F.col(f"s{c}") / F.greatest(f"m{c}", F.lit(1)), F.lit(1e-9)).alias(f"r{c}") for c in (0, 1)]
    left = materialise(left.select("v", "m0", "m1", *rests))
    before = left.select(F.lit(1), "v", F.lit(0).cast("bigint"), F.log(F.expr("r1 / r0")))
    both = pairs.join(left.hint("merge"), "v").join(words.select("w", *[x.alias(f"q{c}") for c, x in enumerate(q)]).hint("merge"), "w")
    p = [F.expr(f"k{c} / greatest(m{c}, 1) + r{c} * q{c}") for c in (0, 1)]
    together = both.select(F.lit(2), "v", "w", F.log(p[1] / p[0]) - F.log(F.expr("r1 * q1 / (r0 * q0)")))
    return materialise(own.union(before).union(together)), other


def _keys(kind: int, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _pair(v, w) + U64(kind)


def ratios(docs: DataFrame, told: DataFrame, other: float, few: bool | None = None) -> DataFrame:
    """docs, which has `_text`, with ratio and n_words instead: the length-normalised log-likelihood ratio of each text.

    Up to BROADCAST_ROWS rows of evidence (or with `few`) are broadcast; beyond, each text's distinct words, words
    before and bigrams are joined with them and summed up again.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rest = [c for c in docs.columns if c != "_text"]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "_text")
    if few if few is not None else told.count() <= BROADCAST_ROWS:
        rows = told.toArrow()
        kind, v, w = (rows[c].to_numpy().astype(np.int64) for c in ("kind", "v", "w"))
        key = _keys(0, v.view(U64), w.view(U64)) + kind.view(U64)
        order = np.argsort(key)
        shared = spark.sparkContext.broadcast((np.append(key[order], U64(0xFFFFFFFFFFFFFFFF)), np.append(rows["value"].to_numpy()[order], 0.0)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, values = shared.value

            def found(key: np.ndarray) -> np.ndarray:
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                return np.where(keys[at] == key, values[at], 0.0)

            for batch in batches:
                at, x, n = batch.schema.get_field_index("_text"), [], []
                for i, j, data, off in slices(batch.column(at)):
                    w, v, doc = _tokens(data, off)
                    none = np.zeros(len(w), U64)
                    each = other + found(_keys(0, none, w)) + found(_keys(1, v, none)) + found(_keys(2, v, w))
                    many = np.bincount(doc, minlength=j - i)
                    n.append(many)
                    x.append(np.bincount(doc, weights=each, minlength=j - i) / np.maximum(1, many))
                held = [batch.column(batch.schema.get_field_index(c)) for c in rest]
                new = [pa.array(np.concatenate(a) if a else np.zeros(0), kind) for a, kind in ((x, pa.float64()), (n, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*held, *new], names=[*rest, "ratio", "n_words"])

        return docs.mapInArrow(run, schema + "ratio double, n_words bigint")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in slices(batch.column(1)):
                w, v, doc = _tokens(data, off)
                none = np.zeros(len(w), U64)
                every = np.arange(j - i)  # a text without a word has a row too
                kinds = [(-1, every, np.zeros(j - i, U64), np.zeros(j - i, U64)), (0, doc, none, w), (1, doc, v, none), (2, doc, v, w)]
                for kind, owner, a, b in kinds:
                    key, one, many = np.unique(mix(_pair(a, b) + owner.astype(U64)), return_index=True, return_counts=True)
                    for at in range(0, len(key), 20_000):
                        k = one[at : at + 20_000]
                        ids = batch.column(0).take(pa.array(i + owner[k]))
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array(np.full(len(k), kind, np.int32)), pa.array(a[k].view(np.int64)), pa.array(b[k].view(np.int64)), pa.array(many[at : at + 20_000])],
                            names=["_row", "kind", "v", "w", "many"],
                        )

    row = F.xxhash64(*[x for c in docs.columns for x in (F.col(c).isNull(), F.col(c).cast("string"))]).alias("_row")
    terms = docs.select(row, "_text").distinct().mapInArrow(split, "_row bigint, kind int, v bigint, w bigint, many bigint")
    sums = terms.join(told.hint("merge"), ["kind", "v", "w"], "left").groupBy("_row")
    sums = sums.agg(
        F.sum(F.col("many") * F.coalesce("value", F.lit(0.0))).alias("x"),
        F.sum(F.when(F.col("kind") == 0, F.col("many")).otherwise(0)).alias("n_words"),
    )
    out = docs.select(row, *rest).join(sums.hint("merge"), "_row")
    return out.select(*rest, F.when(F.col("n_words") > 0, F.lit(other) + F.col("x") / F.col("n_words")).otherwise(0.0).alias("ratio"), "n_words")


def binned(scored: DataFrame) -> np.ndarray:
    """How many rows of scored(ratio, y) of each class (0, 1) fall into each bin of the ratio."""
    k = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("ratio") + SPAN) / (2 * SPAN) * BINS))).cast("int")
    bins = scored.groupBy(k.alias("k"), "y").count().toArrow().to_pandas()
    n = np.zeros((2, BINS))
    n[bins["y"].astype(int), bins["k"]] = bins["count"]
    return n


def separation(n: np.ndarray) -> float:
    """The area under the curve of binned rows: how likely a row of class 1 stands above one of class 0."""
    below = np.cumsum(n[0]) - n[0] / 2
    return float((n[1] * below).sum() / max(1.0, n[0].sum() * n[1].sum()))


def calibrate(n: np.ndarray) -> tuple[list[float], list[float]]:
    """Ratios and probabilities of a monotone map between them, fitted on binned() rows."""
    # Pool adjacent violators; each block then has, from its first to its last bin, its share of class 1, shrunk a little.
    blocks: list[list[float]] = []
    for k in np.flatnonzero(n.sum(axis=0)).tolist():
        blocks.append([float(n[1, k]), float(n[:, k].sum()), k, k])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [blocks[-1][0] + top[0], blocks[-1][1] + top[1], blocks[-1][2], top[3]]
    if not blocks:
        return [0.0], [0.0]
    knots = [(k, (ones + 0.05) / (every + 0.5)) for ones, every, lo, hi in blocks for k in dict.fromkeys((lo, hi))]
    x = [(k + 0.5) / BINS * 2 * SPAN - SPAN for k, _ in knots]
    return x, np.maximum.accumulate([p for _, p in knots]).tolist()


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y) of the documents that labels(id_col, y) has; labels are broadcast up to BROADCAST_ROWS of them."""
    labels = labels.where("y in (0, 1)")
    if labels.count() <= BROADCAST_ROWS:
        labels = F.broadcast(labels)
    return docs.select(id_col, text_col).join(labels.select(id_col, "y"), id_col).toDF("id", "text", "y")


def fit(labelled: DataFrame) -> dict:
    """A scoring model from all rows of labelled(id, text, y); rows without a label of 0 or 1 do not count.

    Three quarters of the rows, by a hash of the id, are counted. On the others the discounts are chosen (by the area under
    the curve, the first of equals) and the scores calibrated.
    """
    rows = labelled.where("y in (0, 1)").withColumn("_part", F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(CALIBRATE)))
    counts = materialise(context_counts(rows.where("_part > 0"), LEAST_PAIR * min(1, *MULTIPLES)))
    asked = materialise(rows.where("_part = 0").select("y", F.col("text").alias("_text")))
    best: dict = {}

    def attempt(multiple: float, odds: float) -> None:
        told, other = evidence_of(counts, LEAST_WORD * multiple, LEAST_PAIR * multiple, odds)
        n = binned(ratios(asked, told, other))
        if not best or separation(n) > best["area"]:
            best.update(area=separation(n), told=told, other=other, n=n, multiple=multiple, odds=odds)

    attempt(1, ODDS)
    if best["n"].sum(axis=1).all():  # without rows of both classes nothing tells which is better
        for odds in OTHER_ODDS:
            attempt(1, odds)
        for multiple in MULTIPLES:
            attempt(multiple, best["odds"])
    x, p = calibrate(best["n"])
    return {k: best[k] for k in ("told", "other", "multiple", "odds", "area")} | {"x": x, "p": p}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, ratio, n_words) and the columns `keep` for each row of docs.

    score is the calibrated probability of class 1, from the length-normalised log-likelihood ratio of the
    whole text. Null and empty texts and texts without a word have ratio 0 and the score that this has.
    Repeated rows score alike; ids and other columns are not looked at. A model of no rows scores all 0.
    """
    text = F.col(text_col).cast("string").alias("_text")
    out = ratios(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text, *keep), model["told"], model["other"])
    x, p = model["x"], model["p"]
    found = F.lit(p[0])
    for a, b, u, v in zip(x, x[1:], p, p[1:], strict=False):
        found = F.when(F.col("ratio") >= a, u + (v - u) * F.least(F.lit(1.0), (F.col("ratio") - a) / max(b - a, 1e-12))).otherwise(found)
    return out.select("doc_id", found.alias("score"), "ratio", "n_words", *keep)
