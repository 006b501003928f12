"""Average-linkage cosine clustering in rounds of reciprocal nearest neighbours, inside partitions of a key."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from themeloom.plans.session import materialise, workers_find_package

#: Clusters of a part up to which one task ends it by all products (these take 8 * SMALL ** 2 bytes).
SMALL = 3000
#: One task also ends a part whose vectors are up to so many numbers (clusters by slots), and whose next round compares up to
#: so many pairs.
ROOM, PAIRS = 1 << 23, 1 << 30
#: Clusters of a block: a task compares two blocks of a large part at a time. Each is sent to the tasks of all other blocks.
BLOCK = 8192
#: Columns of a block's matrix that are multiplied at once, and products that are held at once.
COLUMNS, CELLS = 512, 1 << 22
#: In the place of a nearest neighbour: none is under the threshold; it must be searched.
NONE, ASK = -1, -2


def sparse(points: DataFrame, vec: str) -> Column:
    """A vector, dense or as (i, x), as slots and values of length one; no zero vectors, which have no direction."""
    dense = isinstance(points.schema[vec].dataType, ArrayType)
    x = F.transform(F.col(vec) if dense else F.col(f"{vec}.x"), lambda v: v.cast("double"))
    i = F.sequence(F.lit(0), F.size(vec) - 1) if dense else F.col(f"{vec}.i")
    square = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)
    length = F.when((square == 0) | F.isnan(square), F.raise_error(F.lit("zero vector"))).otherwise(F.sqrt(square))
    scaled = F.transform(F.array(length), lambda n: F.transform(x, lambda v: F.round(v / n, 12)))  # n is found once, not for each v
    return F.struct(i.alias("i"), scaled[0].alias("x"))


def unit(vec: str) -> Column:
    length = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(vec, lambda x: x.cast("double") / length)


def _joined(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join of two sides that grow with the clusters: by a shuffle, as a broadcast in each round would go through the driver."""
    return a.join(b.hint("merge"), on, how)


class _Block:
    """Sparse vectors of some clusters, ids ascending."""

    def __init__(self, rows: pa.Table):
        rows = rows.select(["cid", "size", "i", "x"]).sort_by("cid").combine_chunks()
        self.ids, self.size = rows["cid"], rows["size"].to_numpy().astype(float)
        lists = rows["i"].combine_chunks()
        length = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
        self.start = np.concatenate([[0], np.cumsum(length)])
        self.row = np.repeat(np.arange(len(rows)), length)
        self.slot = lists.flatten().to_numpy()
        self.x = rows["x"].combine_chunks().flatten().to_numpy()

    def means(self) -> _Block:
        """The vectors are sums from now on divided by their sizes."""
        self.x = self.x / self.size[self.row]
        return self

    def dense(self, slots: np.ndarray, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """The columns of some slots, which ascend, in the rows from lo up to hi."""
        hi = len(self.size) if hi is None else hi
        some = slice(self.start[lo], self.start[hi])
        at = np.searchsorted(slots, self.slot[some])
        ok = (at < len(slots)) & (slots[np.minimum(at, len(slots) - 1)] == self.slot[some])
        out = np.zeros((hi - lo, len(slots)))
        out[self.row[some][ok] - lo, at[ok]] = self.x[some][ok]
        return out


def strips(a: _Block, b: _Block):
    """(lo, hi, inner products) of some rows of a with all of b at a time, over the slots that both have."""
    slots = np.intersect1d(a.slot, b.slot)
    some = [slots[at : at + COLUMNS] for at in range(0, len(slots), COLUMNS)]
    whole = b.dense(slots).T if len(some) == 1 else None
    step = max(1, CELLS // len(b.size))
    for lo in range(0, len(a.size), step):
        hi = min(lo + step, len(a.size))
        out = np.zeros((hi - lo, len(b.size)))
        for s in some:
            out += a.dense(s, lo, hi) @ (b.dense(s).T if whole is None else whole)
        yield lo, hi, out


def products(a: _Block, b: _Block) -> np.ndarray:
    """Inner products of all vectors of two blocks."""
    return np.vstack([out for _, _, out in strips(a, b)])


def least(alike: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of the first column at the least distance 1 - alike, to 12 digits, of rows that have one under
    the threshold."""
    top = alike.max(axis=1)
    dist = np.round(1 - top, 12)
    rows = np.flatnonzero(dist < threshold)
    near = alike >= (top - 2e-12)[:, None]
    row, column = np.nonzero(near if len(rows) == len(top) else near[rows])
    same = np.round(1 - alike[rows[row], column], 12) == dist[rows[row]]
    _, first = np.unique(row[same], return_index=True)
    return rows, column[same][first], dist[rows]


def merge_small(ids: np.ndarray, gram: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """The cluster of each id of one part; ids ascend, gram has the inner products of their sums, which are updated.

    The distance 1 - S_a . S_b / (|a| |b|) for sums S of unit vectors is that of average linkage.
    """
    alive, home = np.arange(len(ids)), np.arange(len(ids))
    while len(alive) > 1:
        n = size[alive]
        far = np.round(1 - gram[np.ix_(alive, alive)] / np.outer(n, n), 12)
        np.fill_diagonal(far, np.inf)
        other = far.argmin(axis=1)
        own = np.arange(len(alive))
        low = own[(other[other] == own) & (own < other) & (far[own, other] < threshold)]
        if not len(low):
            break
        into, gone = alive[low], alive[other[low]]
        gram[into] += gram[gone]
        gram[:, into] += gram[:, gone]
        size[into] += size[gone]
        moved = np.arange(len(ids))
        moved[gone] = into
        home, alive = moved[home], np.setdiff1d(alive, gone)
    return ids[home]


def merge_on(mean: np.ndarray, size: np.ndarray, near: np.ndarray, threshold: float) -> np.ndarray:
    """The cluster of each row of one part by rounds that go on from `near`: the row of each one's nearest neighbour, NONE or ASK.

    It holds the mean vectors of the clusters and some rows of products, never all pairs. See _in_rounds for what is searched.
    """
    rows, home = np.arange(len(size)), np.arange(len(size))
    while True:
        asked = np.flatnonzero(near == ASK)
        near[asked] = NONE
        step = max(1, CELLS // max(1, len(size)))
        for lo in range(0, len(asked), step):
            some = asked[lo : lo + step]
            alike = mean[some] @ mean.T
            alike[np.arange(len(some)), some] = -np.inf
            row, column, _ = least(alike, threshold)
            near[some[row]] = column
        own = np.arange(len(size))
        low = own[(near[near] == own) & (own < near)]
        if not len(low):
            return home
        gone, both = near[low], size[low] + size[near[low]]
        mean[low] = (mean[low] * size[low, None] + mean[gone] * size[gone, None]) / both[:, None]
        size[low] = both
        moved = np.arange(len(home))
        moved[rows[gone]] = rows[low]
        home = moved[home]
        kept = near != NONE
        stays = kept[near]
        stays[low] = stays[gone] = False
        stays &= ~np.isin(near, np.concatenate([low, gone]))
        kept[gone] = False
        near = np.where(stays, (np.cumsum(kept) - 1)[near], ASK)[kept]
        mean, size, rows = mean[kept], size[kept], rows[kept]


def _in_tasks(state: DataFrame, threshold: float, small: int) -> DataFrame:
    """(part, cid, into) of parts that are clustered to the end in one task each; `other` is a nearest neighbour, where known."""

    def run(rows: pa.Table) -> pa.Table:
        block = _Block(rows)
        if rows.num_rows <= small:
            into = merge_small(np.arange(len(block.size)), products(block, block), block.size.copy(), threshold)
        else:
            other = rows.select(["cid", "other"]).sort_by("cid")["other"].combine_chunks()
            near = pa.compute.index_in(other, value_set=block.ids.combine_chunks(), skip_nulls=True).fill_null(ASK)
            mean = block.means().dense(np.unique(block.slot))
            into = merge_on(mean, block.size, near.to_numpy(zero_copy_only=False).astype(np.int64), threshold)
        part = rows["part"].take(pa.array(np.zeros(len(into), np.int64)))  # one part
        return pa.table({"part": part, "cid": block.ids, "into": block.ids.take(pa.array(into))})

    kind = {f.name: f.dataType.simpleString() for f in state.schema}
    return state.groupBy("part").applyInArrow(run, f"part {kind['part']}, cid {kind['cid']}, into {kind['cid']}")


def nearest(asked: DataFrame, held: DataFrame, threshold: float = float("inf")) -> DataFrame:
    """(part, cid, other, dist): of each asked cluster the nearest other one that is held in its part, ties to the smaller id.

    Both sides are (part, cid, size, i, x). A part is cut into blocks of about BLOCK clusters by a hash; each pair of an
    asked and a held block is one matrix product in a task, which hands on a row for each asked cluster at most.
    """
    workers_find_package(held.sparkSession)
    count = lambda rows, name: rows.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    blocks = count(asked, "qn").join(count(held, "tn"), "part")
    cut = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["part", "cid", "size", "i", "x", "qb", "tb"]
    q = asked.join(blocks, "part").withColumn("qb", cut("qn")).withColumn("tb", every("tn")).select(*columns)
    t = held.join(blocks, "part").withColumn("tb", cut("tn")).withColumn("qb", every("qn")).select(*columns)
    t = t.toDF(*columns)  # attributes of its own, as both sides may be one table

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table(
                {"part": left["part"].slice(0, 0), "cid": left["cid"].slice(0, 0), "other": left["cid"].slice(0, 0), "dist": pa.array([], pa.float64())},
            )
        a, b = _Block(left).means(), _Block(right).means()
        own = pa.compute.index_in(a.ids, value_set=b.ids.combine_chunks()).fill_null(-1).to_numpy()
        found = []
        for lo, hi, alike in strips(a, b):
            same = np.flatnonzero(own[lo:hi] >= 0)
            alike[same, own[lo:hi][same]] = -np.inf
            row, column, dist = least(alike, threshold)
            found.append((row + lo, column, dist))
        row, other, dist = (pa.array(np.concatenate(x)) for x in zip(*found, strict=True))
        part = left["part"].take(pa.array(np.zeros(len(row), np.int64)))  # one part
        return pa.table({"part": part, "cid": a.ids.take(row), "other": b.ids.take(other), "dist": dist})

    kind = {f.name: f.dataType.simpleString() for f in held.schema}
    found = q.groupBy("part", "qb", "tb").cogroup(t.groupBy("part", "qb", "tb"))
    found = found.applyInArrow(run, f"part {kind['part']}, cid {kind['cid']}, other {kind['cid']}, dist double")
    best = found.groupBy("part", "cid").agg(F.min(F.struct("dist", "other")).alias("m"))
    return best.select("part", "cid", F.col("m.other").alias("other"), F.col("m.dist").alias("dist"))


def _summed(pairs: DataFrame) -> DataFrame:
    """(part, cid, size, i, x) of pairs (part, cid, size, i, x, size_b, i_b, x_b): sums of two sparse vectors."""

    def run(batches):
        for batch in batches:
            held = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("i", "x", "i_b", "x_b")}
            i, x = [], []
            for ia, xa, ib, xb in zip(held["i"], held["x"], held["i_b"], held["x_b"], strict=True):
                slots, place = np.unique(np.concatenate([ia, ib]), return_inverse=True)
                i.append(slots.astype(np.int32))
                x.append(np.bincount(place, weights=np.concatenate([xa, xb])))
            size = pa.compute.add(batch["size"], batch["size_b"])
            out = [batch["part"], batch["cid"], size, pa.array(i, pa.list_(pa.int32())), pa.array(x, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, names=["part", "cid", "size", "i", "x"])

    kind = {f.name: f.dataType.simpleString() for f in pairs.schema}
    return pairs.mapInArrow(run, f"part {kind['part']}, cid {kind['cid']}, size bigint, i array<int>, x array<double>")


def _fitting(state: DataFrame, asked: DataFrame, small: int) -> DataFrame:
    """(part, fit): whether one task can go on with a part."""
    held = state.groupBy("part").agg(F.count("*").alias("n"), (F.max(F.element_at("i", -1)) + F.lit(1).cast("bigint")).alias("width"))
    held = held.join(asked.groupBy("part").agg(F.count("*").alias("asked")), "part", "left")
    pairs = F.col("n").cast("double") * F.coalesce("asked", F.lit(0))
    return held.select("part", ((F.col("n") <= small) | (F.col("n") * F.col("width") <= ROOM) & (pairs <= PAIRS)).alias("fit"))


def _in_rounds(state: DataFrame, threshold: float, small: int) -> DataFrame:
    """(part, cid, into) for the clusters that were merged into others, with where they end.

    Merging two clusters brings neither nearer to a third than the nearer of them was (average linkage is reducible). So
    a nearest neighbour stays until it is merged, and only merged clusters and those that lost their neighbour are searched
    again; a cluster with none under the threshold will never have one, and is neither asked nor held any more. A round
    merges one pair at least, and there may be as many as clusters: so a part is handed to one task as soon as that can go on.
    """
    known, merges, whole = None, [], []
    while True:
        asked = state if known is None else _joined(state, known, ["part", "cid"], "left_anti")
        parts = materialise(_fitting(state, asked, small))
        fit, large = parts.where("fit"), parts.where("not fit")
        if known is None:
            held = state.withColumn("other", F.lit(None).cast(state.schema["cid"].dataType))
        else:
            held = _joined(state, known.drop("dist"), ["part", "cid"], "left")
        whole.append(held.join(fit, "part", "left_semi"))
        if large.isEmpty():
            break
        state, asked = state.join(large, "part", "left_semi"), asked.join(large, "part", "left_semi")
        near = nearest(asked, state, threshold)
        near = materialise(near if known is None else known.join(large, "part", "left_semi").unionByName(near))
        back = near.select("part", F.col("other").alias("cid"), F.col("cid").alias("other"))
        merged = materialise(
            _joined(near, back, ["part", "cid", "other"]).where("cid < other").select("part", F.col("other").alias("cid"), F.col("cid").alias("into")),
        )
        if merged.isEmpty():
            break
        merges.append(merged)
        alive = _joined(state, near.select("part", "cid"), ["part", "cid"], "left_semi")
        gone = _joined(merged, alive.toDF("part", "cid", "size_b", "i_b", "x_b"), ["part", "cid"])
        gone = gone.select("part", F.col("into").alias("cid"), "size_b", "i_b", "x_b")
        new = materialise(_summed(_joined(alive, gone, ["part", "cid"])))
        ends = merged.select("part", "cid").union(merged.select("part", F.col("into").alias("cid")))
        state = materialise(_joined(alive, ends, ["part", "cid"], "left_anti").unionByName(new))
        kept = _joined(near, ends, ["part", "cid"], "left_anti")
        lost = ends.withColumnRenamed("cid", "other")
        known = materialise(_joined(kept, lost, ["part", "other"], "left_anti").select("part", "cid", "other", "dist"))
    moved = _in_tasks(reduce(DataFrame.unionByName, whole), threshold, small).where("cid != into")
    if not merges:
        return moved
    moved = materialise(reduce(DataFrame.unionByName, [moved, *merges]))
    while True:  # a cluster may be merged on: chains are halved until all lead to where they end
        ahead = _joined(moved, moved.toDF("part", "into", "next"), ["part", "into"], "left")
        if ahead.where("next is not null").isEmpty():
            return moved
        moved = materialise(ahead.select("part", "cid", F.coalesce("next", "into").alias("into")))


def average_linkage(points: DataFrame, threshold: float, part: str, id_col: str, vec: str, small: int = SMALL) -> DataFrame:
    """(part, id, cluster) with cluster the least id of its members; clusters at or beyond threshold stay apart.

    `vec` is an array of numbers, or sparse: (i, x) with ascending slots i. Equal vectors start as one cluster with their
    number. All reciprocal nearest neighbours under the threshold merge in a round, which gives the tree of
    one-at-a-time merging. A zero vector has no direction and is an error. Parts of up to `small` distinct vectors, and those
    that ROOM and PAIRS allow, are clustered in a task each; larger ones in rounds of blocks (see nearest) until they are so.
    """
    spark = points.sparkSession
    workers_find_package(spark)
    held = materialise(points.select(F.col(part).alias("part"), F.col(id_col).alias("id"), sparse(points, vec).alias("u")))
    first = materialise(held.groupBy("part", "u").agg(F.min("id").alias("cid"), F.count("*").alias("size")))
    assigned = _joined(held, first, ["part", "u"]).select("part", "id", "cid")
    scaled = F.transform("u.x", lambda v: v * F.col("size"))
    moved = _in_rounds(first.select("part", "cid", "size", "u.i", scaled.alias("x")), threshold, small)
    cluster = F.coalesce("into", "cid").alias("cluster")
    return _joined(assigned, moved, ["part", "cid"], "left").select(F.col("part").alias(part), F.col("id").alias(id_col), cluster)
