"""Near duplicates by SimHash: fingerprints of 64 bits, linked through an index of segments with one bit left open."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.graph import components
from themeloom.llm.kernel import U64, small_batches
from themeloom.plans.session import materialise

#: Seed of XXH64 over a shingle.
SEED = 42
#: Bytes of text whose shingles are counted together; a longer text alone.
SLICE = 1 << 19
#: A segment value that more fingerprints share is looked up by parts of the other bits as well.
MOST = 64
#: Segments are halved down to this many bits, so that what is compared in a bucket differs in as few at most.
NARROW = 8


def _fingerprints(texts: list[bytes], size: int) -> np.ndarray:
    """A fingerprint for each text; zero for those without words."""
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    many = np.zeros(len(texts), np.int64)
    for d, text in enumerate(texts):
        words = text.lower().split()  # bytes: A-Z alone, at ASCII white space
        if words:
            flat = b" ".join(words)
            end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            start = np.append(0, end[:-1] + 1)
            k = min(size, len(words))
            spans = zip(start[: len(words) - k + 1].tolist(), end[k - 1 :].tolist(), strict=True)
            hashes += [xxh64_intdigest(flat[a:b], SEED) for a, b in spans]
            many[d] = len(words) - k + 1
    out, some = np.zeros(len(texts), U64), np.flatnonzero(many)
    if len(some):
        ends = np.cumsum(many[some])
        ones = np.zeros((len(some), 64), np.int64)
        held = np.array(hashes, U64)
        for at in range(0, len(held), 1 << 16):  # some shingles at a time; the counts of a text add up
            bits = np.unpackbits(held[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            a = int(np.searchsorted(ends, at, "right"))
            b = int(np.searchsorted(ends, at + len(bits), "left"))
            cuts = np.maximum(np.append(0, ends)[a : b + 1] - at, 0)
            ones[a : b + 1] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > many[some, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint bigint) for each row: a bit is set if over half of the shingles' XXH64 have it."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out, at = [x or b"" for x in batch.column(1).to_pylist()], [], 0
            while at < len(texts):
                size, stop = len(texts[at]), at + 1
                while stop < len(texts) and size + len(texts[stop]) < SLICE:
                    size += len(texts[stop])
                    stop += 1
                out.append(_fingerprints(texts[at:stop], shingle))
                at = stop
            flat = np.concatenate(out) if out else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flat.view(np.int64))], names=["doc_id", "fingerprint"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, fingerprint bigint")


def _segments(rows: DataFrame, width: int) -> DataFrame:
    """Each row once for each half of the 2 * width bits from `rest` on: `seg` its value, `rest` where the other begins."""
    mask = (1 << width) - 1
    halves = [F.struct(F.expr(f"shiftrightunsigned(fp, rest + {at}) & {mask}L").alias("seg"), (F.col("rest") + (width - at)).alias("rest"), F.lit(at).alias("half")) for at in (0, width)]
    return rows.withColumn("x", F.explode(F.array(*halves))).select(*[c for c in rows.columns if c != "rest"], "x.*")


def _indexed(rows: DataFrame, width: int, wild: bool) -> DataFrame:
    """Rows with the key of each half; with `wild` also of each variant of it with one bit left open.

    Of two values that differ in the open bit alone one has it set. That one writes the variant, with the bit
    cleared; the other is that variant itself, so its plain row stands for all of its variants.
    """
    cut = _segments(rows, width)
    if wild:
        plain = [F.struct(F.col("seg").alias("value"), F.col("left").alias("left"), (F.lit(-1)).alias("open"))]
        # as many differences may remain beside an open bit as are left after it
        open_bits = F.expr(
            f"transform(filter(sequence(0, {width - 1}), i -> left > 1 and (shiftright(seg, i) & 1) = 1),"
            " i -> struct(seg ^ shiftleft(1L, i) as value, left - 1 as left, i as open))"
        )
        cut = cut.withColumn("y", F.explode(F.concat(F.array(*plain), open_bits))).select(
            *cut.columns, F.col("y.value").alias("value"), F.col("y.left").alias("remain"),
        )
    else:
        cut = cut.withColumns({"value": F.col("seg"), "remain": F.col("left")})
    place = [F.lit(width), F.col("rest"), F.col("half"), F.col("value")]
    out = cut.withColumn("key", F.xxhash64("key", *place))
    return out.select("key", "fp", "rest", F.col("remain").alias("left"))


def links(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """Pairs (a, b) of different fingerprints of distinct(fp) that differ in 2 bits at most, once or more.

    Two halves of 32 bits: one of them differs in at most one bit, so the pair meets at that half's value or
    at a variant with one bit left open. Values of more than `most` fingerprints are not compared within;
    their rows are halved on among the bits that are still free (one bit may differ beside an open one, in
    which case one half is equal), down to NARROW bits, where a value has 2**NARROW fingerprints at most.
    """
    spark, width = distinct.sparkSession, 32
    start = distinct.select(F.lit(0).cast("bigint").alias("key"), "fp", F.lit(0).alias("rest"), F.lit(2).alias("left"))
    base, probe, out = start, start, None
    while True:
        plain, probes = materialise(_indexed(base, width, False)), materialise(_indexed(probe, width, True))
        hot = None
        if width > NARROW:
            hot = materialise(plain.groupBy("key").count().where(F.col("count") > most).select("key"))
            hot = None if hot.isEmpty() else hot
        cold, asked = plain, probes
        if hot is not None:
            cold, asked = plain.join(hot, "key", "left_anti"), probes.join(hot, "key", "left_anti")
        near = F.expr("bit_count(a ^ b) <= 2") & (F.col("a") != F.col("b"))
        found = cold.select("key", F.col("fp").alias("a")).join(asked.select("key", F.col("fp").alias("b")), "key").where(near)
        found = materialise(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        out = found if out is None else out.union(found)
        if hot is None:
            return out
        base, probe = plain.join(hot, "key", "left_semi"), probes.join(hot, "key", "left_semi")
        width //= 2


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint bigint, component_id) for each row of docs.

    Words are runs of other than ASCII white space, A-Z lower-cased; shingles of `shingle` words, repeats
    included, are hashed by XXH64; fewer words are one shingle, none give fingerprint zero. Rows link where
    their fingerprints differ in 2 bits at most; component_id is the smallest doc_id reachable. Null, empty
    and blank texts are linked like any other. Each row is judged by its own text, also where ids repeat.
    Rows without a doc_id have a fingerprint, link nothing and have a null component. No rows give no rows.
    """
    held = materialise(fingerprints(docs, shingle, id_col, text_col))
    classes = materialise(held.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    found = components(links(classes.select(F.col("fingerprint").alias("fp"))))
    named = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = named.withColumn("component", F.coalesce("component", "fingerprint"))
    of = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(of, "component").select("fingerprint", "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return held.join(named, "fingerprint", "left").select("doc_id", "fingerprint", component)
