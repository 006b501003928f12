"""Token-id output: best-fit-decreasing packing by a segment tree over room left, as id matrices."""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import small_batches
from themeloom.llm.tokens import pieces, rank_ids

#: Tokens that a task holds before it packs them.
WINDOW = 4_000_000


class RoomTree:
    """Counts of open bins by room left; least(n) is the smallest room of at least n that some bin has."""

    def __init__(self, most: int):
        self.size = 1 << (most + 1).bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def least(self, n: int) -> int | None:
        count, at = self.count, n + self.size
        while not count[at]:
            while at & 1:  # a right child: go up until something is to the right
                at >>= 1
            if not at:
                return None
            at += 1
            if at == 1:
                return None
        while at < self.size:
            at <<= 1
            if not count[at]:
                at += 1
        return at - self.size


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of item numbers."""
    tree, bins, by_room = RoomTree(most), [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = tree.least(lengths[i])
        if room is None:
            b, room = len(bins), most
            bins.append([])
        else:
            b = by_room[room].pop()
            tree.add(room, -1)
        bins[b].append(i)
        by_room.setdefault(room - lengths[i], []).append(b)
        tree.add(room - lengths[i], 1)
    return bins


SCHEMA = (
    "first_doc bigint, first_piece int, n_segments int, n_tokens int, doc_ids array<bigint>, starts array<bigint>, "
    "cu_seqlens array<int>, input_ids binary, position_ids binary, loss_mask binary"
)


def packed_rows(docs: DataFrame, path: str, most: int = 2048, end_id: int = 50256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each packed sequence of at most `most` tokens.

    input_ids: `most` little-endian uint32, padded with end_id; cu_seqlens: 0 and the ends of the segments;
    position_ids: uint32 places that start again at 0 with each segment; loss_mask: a byte for each id, 0
    on padding; doc_ids and starts: the document of each segment and its tokens before it. A document ends
    with end_id; overlong ones are cut into full pieces behind a first one that takes the rest, so reading
    all segments in order gives every document back. A task packs windows of about WINDOW tokens of its
    own rows: no shuffle, bounded memory. (first_doc, first_piece) names a sequence. Null and empty texts
    are end_id alone; repeated rows are written each; null ids stay null; no rows give none.
    """
    small_batches(docs.sparkSession, 500)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        rows = []
        for members in best_fit_decreasing([len(x[3]) for x in held], most):
            members.sort()
            parts = [held[i] for i in members]
            ends = np.cumsum([len(p[3]) for p in parts])
            ids, place, mask = np.full(most, end_id, "<u4"), np.zeros(most, "<u4"), np.zeros(most, np.uint8)
            n = int(ends[-1])
            ids[:n] = np.concatenate([p[3] for p in parts])
            place[:n] = np.concatenate([np.arange(len(p[3])) for p in parts])
            mask[:n] = 1
            rows.append(
                (parts[0][0], parts[0][1], len(parts), n, [p[0] for p in parts], [p[2] for p in parts], [0, *ends.tolist()], ids.tobytes(), place.tobytes(), mask.tobytes()),
            )
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(rank_ids(path, text), np.uint32(end_id))
                for k, (s, n) in enumerate(pieces(len(ids), most)):
                    held.append((doc, k, s, ids[s : s + n]))
                tokens += len(ids)
                if tokens >= WINDOW:
                    packed = pack(held)
                    for at in range(0, packed.num_rows, 256):
                        yield packed.slice(at, 256)
                    held, tokens = [], 0
        if held:
            packed = pack(held)
            for at in range(0, packed.num_rows, 256):
                yield packed.slice(at, 256)

    out = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, SCHEMA)


def write_packed(docs: DataFrame, out: str, path: str, **options) -> None:
    """Write packed_rows as Parquet; a row's binary columns are one line of the id, position and mask matrices."""
    packed_rows(docs, path, **options).write.mode("overwrite").parquet(out)


def read_documents(packed: DataFrame) -> DataFrame:
    """(doc_id, ids) back from packed rows, for distinct doc_ids: the pieces in order, as arrays of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                ids, cu = np.frombuffer(x["input_ids"], "<u4"), x["cu_seqlens"]
                rows += [(d, s, ids[a:b].tolist()) for d, s, a, b in zip(x["doc_ids"], x["starts"], cu, cu[1:], strict=False)]
            held = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(held, [pa.int64(), pa.int64(), pa.list_(pa.int64())], strict=True)], names=["doc_id", "start", "ids"])

    parts = packed.select("doc_ids", "starts", "cu_seqlens", "input_ids").mapInArrow(run, "doc_id bigint, start bigint, ids array<bigint>")
    return parts.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "ids"))), lambda x: x["ids"])).alias("ids"))


