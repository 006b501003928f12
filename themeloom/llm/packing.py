"""Pack documents into sequences: best fit, then swap-based local search on underfull bins."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import small_batches
from themeloom.llm.tokens import pieces, rank_ids
from themeloom.plans.session import materialise

#: Pieces that are packed together in one task; the tail of each such group wastes a bin at most.
GROUP = 8192


def piece_table(docs: DataFrame, path: str, most: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of the pieces of each document."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(rank_ids(path, text), np.uint32(end_id)).astype("<u4", copy=False)
                for k, (s, n) in enumerate(pieces(len(ids), most)):
                    rows.append((doc, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
            held = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(held, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    out = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of item numbers, longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    mask = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        rest = mask >> n
        if rest:
            room = n + (rest & -rest).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = most, len(bins)
            bins.append([i])
        left = room - n
        by_room[left].append(b)
        mask |= 1 << left
    return bins


def local_search(bins: list[list[int]], lengths: list[int], most: int) -> list[list[int]]:
    """Empty underfull bins by moves, one-for-one and two-for-one exchanges, until none raises the squared fill.

    The emptiest bin gives to fuller ones. Giving a net of g tokens from fill s to fill t >= s raises the
    sum of squares by 2g(t - s + g) > 0, so the search ends; it also ends once the bins reach the least
    number that the tokens need. Bins of equal lengths are one kind, and a pair of kinds without an
    exchange is tried once only.
    """
    need = math.ceil(sum(lengths) / most)
    done, kinds = [], {}
    for b in bins:
        b = sorted(b, key=lengths.__getitem__)
        kind = tuple(lengths[i] for i in b)
        if sum(kind) == most:
            done.append(b)
        else:
            kinds.setdefault(kind, []).append(b)
    count = len(bins)
    fills = {kind: sum(kind) for kind in kinds}
    failed: set[tuple] = set()
    stuck: set[tuple] = set()

    def put(b: list[int]) -> None:
        nonlocal count
        kind = tuple(lengths[i] for i in b)
        if not kind:
            count -= 1
        elif sum(kind) == most:
            done.append(b)
        else:
            if kind not in kinds:
                kinds[kind], fills[kind] = [], sum(kind)
                stuck.clear()
            kinds[kind].append(b)

    def take(kind: tuple) -> list[int]:
        b = kinds[kind].pop()
        if not kinds[kind]:
            del kinds[kind], fills[kind]
        return b

    while count > need:
        source = min((k for k in kinds if k not in stuck), key=lambda k: (fills[k], k), default=None)
        if source is None:
            break
        sums = 0
        for x, n in enumerate(source):
            sums |= 1 << n
            for other in source[:x]:
                sums |= 1 << (n + other)
        chosen = None
        for target in sorted((k for k in kinds if fills[k] >= fills[source]), key=lambda k: (-fills[k], k)):
            if (source, target) in failed or (target == source and len(kinds[target]) < 2):
                continue
            within, best = (1 << (most - fills[target])) - 1, (0, 0)
            for back in (0, *dict.fromkeys(target)):
                best = max(best, (((sums >> (back + 1)) & within).bit_length(), -back))
            if best[0]:
                chosen = target, best[0], -best[1]
                break
            failed.add((source, target))
        if chosen is None:
            stuck.add(source)
            continue
        target, net, back = chosen
        giver, getter = take(source), take(target)
        give = next(([i] for i in giver if lengths[i] == net + back), None) or next(
            [i, j] for x, i in enumerate(giver) for j in giver[:x] if lengths[i] + lengths[j] == net + back
        )
        get = [next(i for i in getter if lengths[i] == back)] if back else []
        put(sorted([i for i in giver if i not in give] + get, key=lengths.__getitem__))
        put(sorted([i for i in getter if i not in get] + give, key=lengths.__getitem__))
    return done + [b for held in kinds.values() for b in held]


def pack_pieces(held: DataFrame, groups: int, most: int) -> DataFrame:
    """held with sequence_id and offset. Pieces are dealt over `groups` by a hash; only lengths are packed.

    Columns stay Arrow columns, so wide ids beside nulls come back as they are.
    """

    def run(key: tuple, part: pa.Table) -> pa.Table:
        part = part.drop_columns(["_group"]).sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        lengths = part["length"].to_pylist()
        small = [i for i, n in enumerate(lengths) if n < most]
        short = [lengths[i] for i in small]
        found = [[small[i] for i in b] for b in local_search(best_fit(short, most), short, most)]
        found += [[i] for i, n in enumerate(lengths) if n >= most]
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k, members in enumerate(found):
            at = 0
            for i in sorted(members):
                sequence[i], offset[i] = key[0].as_py() * (1 << 32) + k, at
                at += lengths[i]
        return part.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    group = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).alias("_group")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema) + ", sequence_id bigint, offset bigint"
    return held.select("*", group).groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, most: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row of docs.

    A document is its token ids and end_id; longer ones than `most` are cut into full pieces behind a first
    one that takes the rest. Pieces are packed within groups of about GROUP pieces, dealt by a hash of
    (doc_id, piece), so one long document or a hot key does not land in one task. Null and empty texts are the end
    id alone; repeated rows are packed each; null ids are packed under a null id; no rows give none.
    """
    held = materialise(piece_table(docs, path, most, end_id, id_col, text_col))
    return pack_pieces(held, max(1, -(-held.count() // GROUP)), most)
