"""Hard negatives from vectors: rotated one-bit codes bound every inner product, and only what may matter is scored."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from themeloom.llm.kernel import U64
from themeloom.plans.session import materialise, workers_find_package

#: One-bit codes of a vector: each is of what the codes before it leave over, about 0.6 of it in length.
CODES = 4
#: Bits to which a rotated anchor's components are rounded, one plane for each popcount.
PLANES = 6
#: Bytes of anchors that are sent to all tasks at a time; more anchors take more passes.
ANCHOR_BYTES = 16 << 20
#: Pairs of an anchor and a row whose bounds are held at once.
PAIRS = 1 << 19
#: Rounding of float64, relative to the product of the lengths.
ROUNDING = 1e-9

_INDEX = "id bigint, label bigint, vector binary, codes binary, length double, parts array<double>, left double"


@lru_cache(maxsize=4)
def rotation(n: int) -> np.ndarray:
    """A fixed random rotation of n dimensions."""
    return np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))[0]


def encode(vectors: np.ndarray, codes: int = CODES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, length, alignments, rest) of integer vectors.

    A code has the signs of a rotated unit vector, or of what the codes before it leave over; as a unit vector
    it is stored with its inner product with that, so that the vector is the sum of its aligned codes and a
    rest of known length, which the last code is orthogonal to.
    """
    n = vectors.shape[1]
    turned = vectors.astype(np.float64) @ rotation(n)
    length = np.linalg.norm(turned, axis=1)
    left = turned / np.maximum(length, 1e-300)[:, None]
    bits, parts = [], []
    for _ in range(codes):
        sign = left >= 0
        parts.append(np.abs(left).sum(axis=1) / np.sqrt(n))
        left = left - np.where(sign, 1.0, -1.0) * (parts[-1] / np.sqrt(n))[:, None]
        bits.append(_words(sign))
    return np.stack(bits, 1), length, np.stack(parts, 1), np.linalg.norm(left, axis=1)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, filled up with zeros."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1).view(U64)


class Anchors:
    """Anchors of one dimension: rotated, rounded to bit planes, with the bound of what the rounding moves."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors, self.n = ids, labels, vectors, vectors.shape[1]
        turned = vectors.astype(np.float64) @ rotation(self.n)
        self.length = np.linalg.norm(turned, axis=1)
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-300) / ((1 << PLANES) - 1)
        whole = np.rint((turned - self.low[:, None]) / self.step[:, None])
        moved = turned - (self.low[:, None] + whole * self.step[:, None])
        self.moved = np.minimum(np.abs(moved).sum(axis=1) / np.sqrt(self.n), np.linalg.norm(moved, axis=1))
        self.planes = [_words(whole.astype(np.int64) >> p & 1 == 1) for p in range(PLANES)]
        self.total = whole.sum(axis=1)

    def along(self, who: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The inner product of each rounded anchor with the unit vector of a code, by counting bits."""
        some = np.bitwise_count(code).sum(axis=-1, dtype=np.int64)
        held = np.zeros(np.broadcast_shapes(who.shape, some.shape))
        for p, plane in enumerate(self.planes):
            held += np.float64(1 << p) * np.bitwise_count(plane[who] & code).sum(axis=-1, dtype=np.int32)
        return (self.low[who] * (2 * some - self.n) + self.step[who] * (2 * held - self.total[who])) / np.sqrt(self.n)


class Rows:
    """Some rows of the index that have one dimension."""

    def __init__(self, batch: pa.RecordBatch, pick: np.ndarray, n: int):
        part = batch.take(pa.array(pick))
        self.ids, self.labels = part.column(0).to_numpy(), part.column(1).to_numpy()
        self.vectors = np.stack([np.frombuffer(x, "<i4") for x in part.column(2).to_pylist()]).reshape(-1, n)
        self.codes = np.stack([np.frombuffer(x, U64) for x in part.column(3).to_pylist()]).reshape(len(pick), -1, -(-n // 64))
        self.length, self.left = part.column(4).to_numpy(), part.column(6).to_numpy()
        self.parts = part.column(5).flatten().to_numpy().reshape(len(pick), -1)


def possible(anchors: Anchors, rows: Rows, a: np.ndarray, r: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a, r) those whose inner product may lie from low to high (of each pair), exactly bounded.

    The codes of a row are counted one after another. What they leave over has a known length, so by
    Cauchy-Schwarz its product with the anchor is at most that length times the anchor's: its part
    orthogonal to the last code. Pairs whose interval misses the wanted one are gone before the next code.
    """
    held = moved = np.zeros(len(a))
    count = rows.parts.shape[1]
    gone = np.ones(len(r))  # squared length of what the codes so far leave over
    for k in range(count):
        c = rows.parts[r, k]
        x = anchors.along(a, rows.codes[r, k])
        held, moved = held + c * x, moved + c * anchors.moved[a]
        gone = gone - c * c
        rest = rows.left[r] if k == count - 1 else np.sqrt(np.maximum(gone, 0))
        inside = np.maximum(np.abs(x) - anchors.moved[a], 0)
        across = np.sqrt(np.maximum(anchors.length[a] ** 2 - inside**2, 0))
        width = (rest * across + moved + ROUNDING * anchors.length[a]) * rows.length[r]
        middle = held * rows.length[r]
        ok = np.flatnonzero((middle + width >= low) & (middle - width <= high))
        a, r, low, high, held, moved, gone = (v[ok] for v in (a, r, low, high, held, moved, gone))
    return a, r


def inner(anchors: Anchors, rows: Rows, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs."""
    out, width = np.empty(len(a), np.int64), max(1, (1 << 22) // max(1, anchors.n))
    for at in range(0, len(a), width):
        x = anchors.vectors[a[at : at + width]].astype(np.int64)
        out[at : at + width] = (x * rows.vectors[r[at : at + width]]).sum(axis=1)
    return out


class Best:
    """The best few of each slot: highest score first, ties by smaller id."""

    def __init__(self, slots: int, few: int):
        self.few, self.floor = few, np.full(slots, np.iinfo(np.int64).min)
        self.slot = self.score = self.id = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.append(True, slot[1:] != slot[:-1])
        place = np.arange(len(slot)) - np.maximum.accumulate(np.where(first, np.arange(len(slot)), 0))
        last = place == self.few - 1
        self.floor[slot[last]] = score[last]
        ok = place < self.few
        self.slot, self.score, self.id = slot[ok], score[ok], ids[ok]


def quantised(vectors: DataFrame, label: Column | str = "label", scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, label, vector) with components floor(scale * x); rows with a null id, label or vector, without components
    or with a null or non-finite component are left out."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.when(fine, x).alias("vector"))
    rows = rows.where("id is not null and label is not null and size(vector) > 0")
    return rows.withColumn("vector", F.transform("vector", lambda v: F.floor(v.cast("double") * scale).cast("bigint")))


def index(rows: DataFrame, codes: int = CODES) -> DataFrame:
    """Rows of (id, label, vector array<bigint>) with their codes, written once; components have to fit into 32 bits.

    Of rows that repeat an id the one with the greatest (label, vector) counts.
    """
    workers_find_package(rows.sparkSession)
    one = rows.groupBy("id").agg(F.max(F.struct("label", "vector")).alias("x")).select("id", "x.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)], np.int64)
            for n in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == n)))
                for at in range(0, part.num_rows, 1024):
                    few = part.slice(at, 1024)
                    held = few.column(2).flatten().to_numpy().reshape(-1, n)
                    if np.abs(held).max() >= 1 << 31 or int(np.abs(held).max()) ** 2 * n >= 1 << 63:
                        raise ValueError("components are too large for integer scores of 64 bits")
                    bits, length, parts, left = encode(held, codes)
                    out = [few.column(0), few.column(1), pa.array([v.tobytes() for v in held.astype("<i4")], pa.binary())]
                    out += [pa.array([v.tobytes() for v in bits], pa.binary()), pa.array(length), pa.array(list(parts), pa.list_(pa.float64())), pa.array(left)]
                    yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in _INDEX.split(", ")])

    return materialise(one.mapInArrow(run, _INDEX))


def _blocks(batch: pa.RecordBatch, groups: dict[int, Anchors]) -> Iterator[tuple[Anchors, Rows, np.ndarray]]:
    """For the dimensions that anchors have, some rows of a batch and some anchors, PAIRS pairs at a time."""
    size = np.array([len(x) // 4 for x in batch.column(2).to_pylist()], np.int64)
    for n, anchors in groups.items():
        pick = np.flatnonzero(size == n)
        for at in range(0, len(pick), 1024):
            rows = Rows(batch, pick[at : at + 1024], n)
            for b in range(0, len(anchors.ids), PAIRS // 1024):
                yield anchors, rows, np.arange(b, min(b + PAIRS // 1024, len(anchors.ids)))


def _groups(held: pa.Table) -> dict[int, Anchors]:
    size = np.array([len(x) // 4 for x in held["vector"].to_pylist()], np.int64)
    out = {}
    for n in np.unique(size).tolist():
        part = held.filter(pa.array(size == n))
        vectors = np.stack([np.frombuffer(x, "<i4") for x in part["vector"].to_pylist()])
        out[n] = Anchors(part["id"].to_numpy(), part["label"].to_numpy(), vectors)
    return out


def _top(found: DataFrame, by: list[str], score: str, row: str, few: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(row))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= few)


def positives(rows: DataFrame, anchors: pa.Table, few: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the first `few` other rows of each anchor's label."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _groups(shared.value)
        best = {n: Best(len(a.ids), few) for n, a in groups.items()}
        for batch in batches:
            for held, part, some in _blocks(batch, groups):
                top = best[held.n]
                a, r = np.nonzero((held.labels[some, None] == part.labels) & (held.ids[some, None] != part.ids))
                a = some[a]
                low = top.floor[a].astype(np.float64)
                a, r = possible(held, part, a, r, low, np.full(len(a), np.inf))
                top.add(a, inner(held, part, a, r), part.ids[r])
        for n, top in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(groups[n].ids[top.slot]), pa.array(top.id), pa.array(top.score)], names=["anchor_id", "positive_id", "positive_score"])

    found = rows.mapInArrow(run, "anchor_id bigint, positive_id bigint, positive_score bigint")
    return _top(found, ["anchor_id"], "positive_score", "positive_id", few).drop("rank")


def negatives(rows: DataFrame, anchors: pa.Table, wanted: pa.Table, few: int, least: int, most: int) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row of `wanted` the first `few`
    rows of other labels from `least` to `most` hundredths of its score."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, wanted = shared.value
        groups = _groups(anchors)
        slots, limits, best, spread = {}, {}, {}, {}
        for n, held in groups.items():
            own = wanted.filter(pa.array(np.isin(wanted["anchor_id"].to_numpy(), held.ids)))
            order = np.argsort(held.ids)
            at = order[np.searchsorted(held.ids[order], own["anchor_id"].to_numpy())]
            own = own.take(pa.array(np.argsort(at, kind="stable")))
            at, score = np.sort(at), own["positive_score"].to_numpy()
            slots[n], limits[n] = own, (-(-least * score // 100), most * score // 100)
            best[n] = Best(len(score), few)
            spread[n] = np.searchsorted(at, np.arange(len(held.ids) + 1))  # slots of each anchor
        for batch in batches:
            for held, part, some in _blocks(batch, groups):
                low, high = limits[held.n]
                if not len(low):
                    continue
                top, cut = best[held.n], spread[held.n]
                floor = np.maximum(low, top.floor)
                have = cut[:-1] < cut[1:]
                wide_low, wide_high = np.full(len(have), np.inf), np.full(len(have), -np.inf)
                wide_low[have] = np.minimum.reduceat(np.where(low <= high, floor, np.inf), cut[:-1][have])
                wide_high[have] = np.maximum.reduceat(np.where(low <= high, high, -np.inf), cut[:-1][have])
                some = some[wide_low[some] <= wide_high[some]]
                a, r = np.nonzero(held.labels[some, None] != part.labels)
                a = some[a]
                a, r = possible(held, part, a, r, wide_low[a], wide_high[a])
                score = inner(held, part, a, r)
                many = cut[a + 1] - cut[a]
                pair = np.repeat(np.arange(len(a)), many)
                slot = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + cut[a][pair]
                ok = (score[pair] >= floor[slot]) & (score[pair] <= high[slot])
                top.add(slot[ok], score[pair[ok]], part.ids[r[pair[ok]]])
        for n, top in best.items():
            own = slots[n].take(pa.array(top.slot)).combine_chunks()
            out = [own["anchor_id"], own["positive_id"], own["positive_score"], pa.array(top.id), pa.array(top.score)]
            out = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in out]
            yield pa.RecordBatch.from_arrays(out, names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    found = rows.mapInArrow(run, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    found = _top(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", few)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(rows: DataFrame, is_anchor: Column, few_positives: int = 5, few: int = 3, least: int = 50, most: int = 95, codes: int = CODES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows (id, label, vector array<bigint>).

    A row's score is its integer inner product with the anchor; higher first, ties by smaller id. An anchor's
    positives are its first `few_positives` other rows of its label; for each of them come the first `few` rows of
    other labels with least * positive_score <= 100 * negative_score <= most * positive_score, so none for
    a negative score. Vectors are compared with those of as many components only. Anchors meet all rows, in blocks of
    about ANCHOR_BYTES, and the rows stay where they are; each task keeps a few of them for each anchor of a
    block. Rows that repeat an id count once (see index); equal vectors are told apart by id. No rows give none.
    """
    spark = rows.sparkSession
    held = index(rows, codes)
    asked = held.where(is_anchor).select("id", "label", "vector")
    size = asked.agg(F.sum(F.octet_length("vector") + 16)).first()[0] or 0
    blocks = max(1, -(-size // ANCHOR_BYTES))
    out = spark.createDataFrame(
        [],
        T.StructType(
            [T.StructField(c, T.IntegerType() if c == "rank" else T.LongType()) for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")],
        ),
    )
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        if own.num_rows:
            near = positives(held, own, few_positives).toArrow()
            out = out.union(materialise(negatives(held, own, near, few, least, most)))
    return out
