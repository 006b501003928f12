"""Near-duplicate documents by b-bit MinHash, bands, and exact Jaccard on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.llm.graph import components
from themeloom.llm.kernel import LOWER, SPACE, U64, byte_values, mix, prefix, separated, slices, small_batches, span_hash, spans
from themeloom.plans.session import materialise

#: Bands of ROWS minima: a pair at Jaccard 0.8 shares none of 40 bands with probability (1 - 0.8**6)**40 = 5e-6.
BANDS, ROWS = 40, 6
BITS = 4
#: Minima, with one bit of each, of the longer signature that rows of still mixed buckets get.
LONG = 2048
#: Rows of a bucket that are compared at once with as many others.
BLOCK = 1000
#: How far under the threshold an estimate may lie: 4 standard deviations, for either length.
SLACK, LONG_SLACK = 0.11, 0.05

_VALUES = byte_values(5)
_A = mix(np.arange(1, LONG + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_B = mix(np.arange(1, LONG + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F))


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text of a column."""
    mult = mix(np.arange(1, k + 1, dtype=U64) * U64(0xA24BAED4963EE407)) | U64(1)
    for i, j, data, off in slices(column):
        data, at = separated(LOWER[data], off)
        start, end = spans(~SPACE[data])
        word = span_hash(prefix(_VALUES[data]), start, end)
        first = np.searchsorted(start, at)
        if len(word) >= k:
            run = np.zeros(len(word) - k + 1, U64)
            for s in range(k):
                run += word[s : len(word) - k + 1 + s] * mult[s]
            run = mix(run)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= k:
                yield np.unique(run[a : b - k + 1])
            elif b > a:
                few = np.zeros(1, U64)
                for s in range(b - a):
                    few += mix(word[a + s : a + s + 1] + U64(s + 1))
                yield mix(few + U64(b - a))
            else:
                yield np.zeros(0, U64)


def minima(shingles: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """The minimum of each of n hash functions over a set, 32 bits each."""
    low = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 1024):
        h = (shingles[at : at + 1024, None] * _A[:n] + _B[:n]) >> U64(32)
        np.minimum(low, h.min(axis=0).astype(np.uint32), out=low)
    return low


def pack(low: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low bits of each minimum in planes: 64 first bits to a word, then their second bits, and so on."""
    groups = -(-len(low) // 64)
    held = np.zeros(groups * 64, np.uint32)
    held[: len(low)] = low
    planes = [np.packbits((held >> np.uint32(k)) & np.uint32(1)).view(">u8").astype(U64) for k in range(bits)]
    return np.stack(planes, 1).reshape(-1)


def band_keys(low: np.ndarray) -> np.ndarray:
    weight = mix(np.arange(1, ROWS + 1, dtype=U64)) | U64(1)
    return mix((low.reshape(BANDS, ROWS).astype(U64) * weight).sum(axis=1, dtype=U64) + np.arange(BANDS, dtype=U64))


def signatures(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, h1, h2, bands, sig) of each row; empty arrays where the set is empty."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, h1, h2, bands, sigs = [], [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                ns.append(len(s))
                h1.append(np.int64(s.sum(dtype=U64).astype(np.int64)))
                h2.append(np.int64(mix(s).sum(dtype=U64).astype(np.int64)))
                low = minima(s)
                bands.append(band_keys(low) if len(s) else np.zeros(0, U64))
                sigs.append(pack(low) if len(s) else np.zeros(0, U64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), _lists(bands), _lists(sigs)],
                names=["doc_id", "n", "h1", "h2", "bands", "sig"],
            )

    out = "doc_id bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>, sig array<bigint>"
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, out)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0, U64)
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def similarity(a: str, b: str, n: int = BANDS * ROWS, bits: int = BITS) -> Column:
    """Jaccard estimate of two packed signatures of n minima, corrected for b-bit collisions."""
    differ = []
    for g in range(-(-n // 64)):
        planes = [f"({a}[{g * bits + k}] ^ {b}[{g * bits + k}])" for k in range(bits)]
        differ.append(f"bit_count({' | '.join(planes)})")
    c = 2.0**-bits
    return F.expr(f"greatest(0D, (1D - ({' + '.join(differ)}) / {n}D - {c}D) / {1 - c}D)")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the rows whose doc_id is in ids(doc_id); one row for each id, the greatest text of it."""
    return docs.join(ids.distinct().hint("merge"), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))


def long_signatures(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pack(minima(s, LONG), 1) for s in shingle_sets(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(rows)], names=["rep", "long"])

    return texts_of(docs, ids).mapInArrow(run, "rep bigint, long array<bigint>")


def confirm(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    held = texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), k))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], names=["doc_id", "s"])

    sets = held.mapInArrow(run, "doc_id bigint, s array<bigint>")
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a")
    both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
    both = both.withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where((F.size("sa") + F.size("sb") - F.col("i")) * percent <= F.col("i") * 100).select("a", "b")


def _agree(a: np.ndarray, b: np.ndarray, n: int, bits: int) -> np.ndarray:
    """similarity() of rows of packed signatures, in numpy."""
    differ = np.bitwise_count(np.bitwise_or.reduce((a ^ b).reshape(len(a), a.shape[1] // bits, bits), axis=2)).sum(axis=1)
    c = 2.0**-bits
    return (1 - differ / n - c) / (1 - c)


def _bucket_pairs(x: dict[str, np.ndarray], band: int, apart: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one bucket (of its two blocks, if apart) that differ in label and may be alike enough."""
    n, out = len(x["rep"]), []
    for at in range(0, n, 64):
        i, j = np.nonzero(x["label"][at : at + 64, None] != x["label"][None, :])
        i += at
        less, more = np.minimum(x["n"][i], x["n"][j]), np.maximum(x["n"][i], x["n"][j])
        ok = (x["rep"][i] < x["rep"][j]) & (100 * less >= percent * more)
        if apart:
            ok &= x["block"][i] != x["block"][j]
        i, j = i[ok], j[ok]
        for name, size, bits, slack in (("sig", BANDS * ROWS, BITS, SLACK), ("long", LONG, 1, LONG_SLACK)):
            ok = _agree(x[name][i], x[name][j], size, bits) >= percent / 100 - slack
            i, j = i[ok], j[ok]
        ok = (x["bands"][i] == x["bands"][j]).argmax(axis=1) == band  # each pair at its first shared band
        out.append((i[ok], j[ok]))
    i, j = (np.concatenate([p[k] for p in out]) for k in (0, 1))
    return x["rep"][i], x["rep"][j]


def across_labels(rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different labels from rows(band, key, size, rep, label, n, sig, long, bands).

    A bucket is cut into blocks of about BLOCK rows, and a task compares two blocks at a time by their
    signatures, so no bucket has to fit into a task and only pairs that are alike enough leave it.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    keys = ["band", "key", "lo", "hi"]
    cut = cut.select(*keys, "block", "rep", "label", "n", "sig", "long", "bands").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            part = part.combine_chunks()
            x = {c: part[c].to_numpy() for c in ("band", "key", "lo", "hi", "block", "rep", "label", "n")}
            for c in ("sig", "long", "bands"):
                flat = part[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                x[c] = flat.view(U64).reshape(len(x["rep"]), -1)
            new = np.zeros(len(x["rep"]), bool)
            for c in keys:
                new[1:] |= x[c][1:] != x[c][:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), len(new)]
            found = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    one = {c: v[a:b] for c, v in x.items()}
                    found.append(_bucket_pairs(one, int(one["band"][0]), bool(one["lo"][0] != one["hi"][0]), percent))
            return tuple(np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (0, 1))

        def result(part: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in pairs(part)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            same = np.ones(held.num_rows, bool)
            for c in keys:
                v = held[c].to_numpy()
                same &= v == v[-1]
            whole = held.num_rows - int(same.sum())  # the last bucket may go on in the next batch
            if whole:
                yield result(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None:
            yield result(held)

    return cut.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs.

    Words are runs of other than ASCII white space, A-Z lower-cased; a set has the distinct `shingle`-word
    shingles of a text, or the whole of a shorter one. Rows are linked if 100 * intersection >= percent *
    union. Rows of equal sets form one class that a single row stands for. Bands of minima give candidates:
    first each representative with its most alike bucket head, then, in buckets that still hold rows of
    several heads, the pairs across them whose packed signatures, short and long, agree well enough, each
    pair at the first band that it shares. All links are confirmed on full sets. Null, empty and blank texts have
    empty sets and are linked with nothing. doc_id identifies a document: rows that repeat one are one node, for which the
    greatest text speaks; n_shingles is that of each row's own text.
    Rows with a null doc_id are kept by themselves, with a null component. No rows give no rows.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sig = materialise(signatures(docs, shingle))
    some = sig.where("doc_id is not null")
    again = materialise(some.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id"))
    spoken = None if again.isEmpty() else materialise(signatures(texts_of(docs, again), shingle))
    nodes = some if spoken is None else materialise(some.join(again.hint("merge"), "doc_id", "left_anti").unionByName(spoken))
    nodes = nodes.where("n > 0")
    classes = materialise(nodes.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")))
    reps = nodes.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    reps = materialise(reps.select(F.col("doc_id").alias("rep"), "n", "bands", "sig"))
    buckets = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    heads = buckets.groupBy("band", "key").agg(F.min("rep").alias("head"), F.count("*").alias("size")).where("size > 1")
    buckets = materialise(buckets.join(heads.drop("size"), ["band", "key"]))
    marks = reps.select("rep", "n", "sig", "bands")
    near = F.col("like") >= percent / 100 - SLACK
    sized = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    star = buckets.where("rep <> head").select(F.col("rep").alias("b"), F.col("head").alias("a")).distinct()
    short = reps.select("rep", "n", "sig")
    star = star.join(short.toDF("b", "nb", "sb"), "b").join(short.toDF("a", "na", "sa"), "a").where(sized)
    star = star.withColumn("like", similarity("sa", "sb")).where(near).groupBy("b").agg(F.max_by("a", F.struct("like", -F.col("a"))).alias("a"))
    links = materialise(confirm(docs, materialise(star.select("a", "b")), shingle, percent))
    # Labels that only collapse stars: a row's head, and that head's own.
    label = links.toDF("up", "rep")
    up = links.toDF("top", "up").hint("merge")
    label = label.join(up, "up", "left").select("rep", F.coalesce("top", "up").alias("label"))
    placed = buckets.join(label.hint("merge"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = placed.groupBy("band", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"))
    open_rows = materialise(placed.join(mixed.where("lo < hi").select("band", "key", "size").hint("merge"), ["band", "key"]))
    marks = marks.join(long_signatures(docs, open_rows.select(F.col("rep").alias("doc_id")), shingle), "rep")
    open_rows = materialise(open_rows.select("band", "key", "size", "rep", "label").join(marks.hint("merge"), "rep"))
    across = materialise(across_labels(open_rows, percent))
    first = components(links.union(confirm(docs, across, shingle, percent)))
    of_class = classes.join(first.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", "n", F.coalesce("component", "rep").alias("component")
    )
    rows = sig.select("doc_id", F.col("n").alias("n_shingles"), "h1", "h2", "n")
    if spoken is not None:  # rows that repeat an id go with the text that speaks for it
        whose = sig.select("doc_id", F.col("n").alias("n_shingles")).join(spoken.select("doc_id", "h1", "h2", "n").hint("merge"), "doc_id")
        rows = rows.join(again.hint("merge"), "doc_id", "left_anti").unionByName(whose)
    out = rows.join(of_class, ["h1", "h2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
