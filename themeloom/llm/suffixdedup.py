"""Repeated passages across documents, by prefix-free parsing: phrases, their dictionary, and sorted suffixes.

A rolling hash of K bytes sets triggers: in every LENGTH-byte window the K-gram of least hash (the leftmost of
equal ones) is the trigger, so equal windows have the same trigger at the same place. The windows that share one
trigger make a phrase; it runs to the end of its last window. A repetitive corpus has few distinct phrases: equal ones
need one comparison for all their windows, and only phrases that agree in the trigger but not in whole are sorted.
There the text up to the end of the trigger is a word of the dictionary, and what follows is its parse. The suffixes
of the dictionary's words are sorted, and so are the distinct continuations of the parse; no suffix begins with another,
as the trigger stands at its end alone. The two ranks together put all windows of the trigger into corpus order, where
equal windows are neighbours: they have one suffix of the dictionary, and continuations that agree as far as the window
goes. Each class of equal windows then knows the least document it stands in.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import U64, byte_values, mix, prefix, small_batches, span_hash

LENGTH, K = 50, 20
#: Bytes of text that are parsed together in a task, and bytes that are hashed at once.
GROUP_BYTES, SLICE = 2_500_000, 1 << 18
#: Suffixes that are sorted at once, and bytes of them: fewer suffixes where windows are long.
SORTED, SORTED_BYTES = 200_000, 64 << 20
#: Longest window: a single phrase's suffixes take the square of it.
LONGEST = 8192
NONE, WHOLE, PARTLY = 0, 1, 2

_VALUES = byte_values(7)
_RESULT = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]
_PLACE = U64((1 << 24) - 1)


def phrases(flat: np.ndarray, base: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Phrases of texts flat[base[i]:base[i + 1]]: (first window, windows, trigger hash, phrase hash, place of the trigger)."""
    k = min(K, length)
    w = length - k + 1
    out: list[tuple] = []
    starts, at, n = [], 0, len(base) - 1
    while at < n:  # texts of about SLICE bytes together; a longer one in parts that overlap
        stop = max(at + 1, int(np.searchsorted(base, base[at] + SLICE, "right")) - 1)
        if base[stop] - base[at] <= 4 * SLICE:
            starts.append((int(base[at]), int(base[stop]), base[at : stop + 1]))
        else:
            for a in range(int(base[at]), int(base[stop]), SLICE):
                b = min(int(base[stop]), a + SLICE + length - 1)
                starts.append((a, b, np.array([a, b])))
        at = stop
    for a, b, cuts in starts:
        n = b - a
        if n < length:
            continue
        sums = prefix(_VALUES[flat[a:b]])
        at = np.arange(n - k + 1)
        gram = span_hash(sums, at, at + k)
        low = (gram & ~_PLACE) | at.astype(U64)
        width = 1
        while width * 2 <= w:
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        low = np.minimum(low[: n - length + 1], low[w - width : w - width + n - length + 1])
        trigger = (low & _PLACE).astype(np.int64)
        window = np.arange(n - length + 1)
        text = np.searchsorted(cuts - a, window, "right")
        inside = window + length <= (cuts - a)[np.minimum(text, len(cuts) - 1)]
        window, trigger, text = window[inside], trigger[inside], text[inside]
        if not len(window):
            continue
        new = np.ones(len(window), bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(window)))
        p = window[first]
        out.append((p + a, many, gram[trigger[first]], span_hash(sums, p, p + many - 1 + length), trigger[first] - p))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(U64), z.astype(U64), z
    return tuple(np.concatenate([o[i] for o in out]) for i in range(5))


class Parse:
    """The phrases of the documents of one group, and its dictionary: distinct phrases in order of trigger."""

    def __init__(self, frame: pd.DataFrame, length: int, buckets: int):
        frame = frame.sort_values(["doc_id", "_order"], kind="stable", ignore_index=True)
        self.frame, self.length = frame, length
        raw = [(t or "").encode() for t in frame["text"]]
        self.ids = frame["doc_id"].to_numpy(np.int64)
        self.base = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.at, self.many, trigger, whole, self.lead = phrases(self.flat, self.base, length)
        # A trigger's hash is the least of its window: mixed again, or all would meet in the first buckets.
        self.core = (mix(trigger) >> U64(32)).astype(np.uint32)
        self.doc = self.ids[np.searchsorted(self.base, self.at, "right") - 1]
        order = np.lexsort((whole, self.core))
        core, whole = self.core[order], whole[order]
        new = np.ones(len(order), bool)
        new[1:] = (core[1:] != core[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(new)
        self.number = np.zeros(len(order), np.int64)  # of the phrase in the dictionary
        self.number[order] = np.cumsum(new) - 1
        self.entry_core, self.entry_hash = core[first], whole[first]
        self.entry_doc = np.minimum.reduceat(self.doc[order], first) if len(first) else np.zeros(0, np.int64)
        least = np.where(self.doc[order] == np.repeat(self.entry_doc, np.diff(np.append(first, len(order)))), order, len(order))
        self.entry_at = np.minimum.reduceat(least, first) if len(first) else np.zeros(0, np.int64)
        bucket = self.entry_core.astype(np.int64) * buckets >> 32
        self.bucket, cut = np.unique(bucket, return_index=True)
        self.cut = np.append(cut, len(bucket))

    def requests(self) -> list[tuple[int, bytes]]:
        """For each bucket the dictionary's triggers, phrase hashes and least documents."""
        return [(int(b), _join(self.entry_core[s], self.entry_hash[s], self.entry_doc[s])) for b, s in self._parts()]

    def _parts(self):
        return [(b, slice(x, y)) for b, x, y in zip(self.bucket, self.cut, self.cut[1:], strict=False)]

    def answers(self, rows: pd.DataFrame, kind: str, fill) -> np.ndarray:
        """What the buckets said of each entry."""
        out = np.full(len(self.entry_core), fill)
        held = dict(zip(rows["bucket"], rows["payload"], strict=True))
        for b, s in self._parts():
            if int(b) in held:
                out[s] = np.frombuffer(held[int(b)], kind)
        return out

    def strings(self, status: np.ndarray) -> list[tuple[int, bytes]]:
        """For each bucket the phrases that have to be sorted: window counts, places of triggers, triggers, documents and bytes."""
        out = []
        for b, s in self._parts():
            e = np.flatnonzero(status[s] == PARTLY) + s.start
            if len(e):
                i = self.entry_at[e]
                size = self.many[i] - 1 + self.length
                text = b"".join(self.flat[p : p + n].tobytes() for p, n in zip(self.at[i], size, strict=True))
                parts = self.many[i].astype(np.uint16), self.lead[i].astype(np.uint16), self.entry_core[e], self.entry_doc[e], np.frombuffer(text, np.uint8)
                out.append((int(b), _join(*parts)))
        return out

    def flags(self, status: np.ndarray, held: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where each sorted entry's windows begin in a list of flags, and that list, from the answers of the buckets."""
        base, out, size = np.zeros(len(status), np.int64), [], 0
        for b, s in self._parts():
            e = np.flatnonzero(status[s] == PARTLY) + s.start
            if len(e):
                many = self.many[self.entry_at[e]]
                base[e] = size + np.cumsum(many) - many
                size += int(many.sum())
                out.append(np.unpackbits(np.frombuffer(held[int(b)], np.uint8), count=int(many.sum())) if int(b) in held else np.zeros(int(many.sum()), np.uint8))
        return base, np.concatenate(out) if out else np.zeros(0, np.uint8)

    def covered(self, status: np.ndarray, base: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """Which bytes of flat a window with an earlier document covers."""
        edge = np.zeros(len(self.flat) + 1, np.int32)
        entry = self.number
        whole = (self.doc > self.entry_doc[entry]) | (status[entry] == WHOLE)
        np.add.at(edge, self.at[whole], 1)
        np.add.at(edge, self.at[whole] + self.many[whole] - 1 + self.length, -1)
        part = np.flatnonzero(~whole & (status[entry] == PARTLY))
        for o in range(int(self.many[part].max(initial=0))):
            part = part[self.many[part] > o]
            p = self.at[part[flags[base[entry[part]] + o] == 1]] + o
            np.add.at(edge, p, 1)
            np.add.at(edge, p + self.length, -1)
        np.cumsum(edge, out=edge)
        return edge[:-1] > 0


def _join(*arrays: np.ndarray) -> bytes:
    """Arrays of one length (the last may be longer) behind that length; int64 as a table of values and places."""
    out = [np.array([len(arrays[0])], np.int64).tobytes()]
    for a in arrays:
        if a.dtype == np.int64:
            values, place = np.unique(a, return_inverse=True)
            out += [np.array([len(values)], np.int64).tobytes(), values.tobytes(), place.astype(np.uint16 if len(values) <= 65536 else np.uint32).tobytes()]
        else:
            out.append(a.tobytes())
    return b"".join(out)


def _split(data: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in kinds:
        if kind == "id":
            m = int(np.frombuffer(data, np.int64, 1, at)[0])
            values = np.frombuffer(data, np.int64, m, at + 8)
            small = np.dtype(np.uint16 if m <= 65536 else np.uint32)
            out.append(values[np.frombuffer(data, small, n, at + 8 + 8 * m)])
            at += 8 + 8 * m + small.itemsize * n
        elif kind == "rest":
            out.append(np.frombuffer(data, np.uint8, -1, at))
        else:
            out.append(np.frombuffer(data, kind, n, at))
            at += np.dtype(kind).itemsize * n
    return out


def compare_phrases(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket of all dictionaries: for each entry whether an earlier document has the phrase, or may have parts."""
    parts = [_split(p, "<u4", "<u8", "id") for p in rows["payload"]]
    core, whole, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((whole, core))
    c, h, d = core[order], whole[order], doc[order]
    new_core = np.append(True, c[1:] != c[:-1])
    new = new_core | np.append(True, h[1:] != h[:-1])
    first, first_core = np.flatnonzero(new), np.flatnonzero(new_core)
    least = np.minimum.reduceat(d, first)[np.cumsum(new) - 1]
    lo, hi = (f.reduceat(least, first_core)[np.cumsum(new_core) - 1] for f in (np.minimum, np.maximum))
    status = np.empty(len(order), np.uint8)
    status[order] = np.where(d > least, WHOLE, np.where(lo != hi, PARTLY, NONE))
    ends = np.cumsum([len(p[0]) for p in parts])
    return rows.assign(payload=[s.tobytes() for s in np.split(status, ends[:-1])])


def _rows_of(text: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """text[start:start + size] of each, filled up with zeros to `width` bytes; text goes on for `width` bytes more."""
    if not width:
        return np.zeros((len(start), 0), np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(text, width)[start]
    rows[np.arange(width) >= size[:, None]] = 0
    return rows


def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each distinct row, and the rank of each row, in byte order."""
    keys = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel() if rows.shape[1] else np.zeros(len(rows), "V1")
    order = np.argsort(keys.view(f"S{keys.itemsize}"), kind="stable")
    new = np.append(True, (rows[order[1:]] != rows[order[:-1]]).any(axis=1)) if len(rows) else np.zeros(0, bool)
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order[new], rank


def _classes(text: np.ndarray, start: np.ndarray, lead: np.ndarray, many: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of phrases, each phrase's one after another, in corpus order, and which of them begin a new class.

    A phrase has its trigger of K bytes at `lead`: text[start : start + lead + k] is its word, the rest its continuation.
    """
    k = min(K, length)
    word = _rows_of(text, start, lead + k, length)
    first, of = _ranked(np.concatenate([word, (lead + k).astype(">u2").view(np.uint8).reshape(-1, 2)], axis=1))
    suffixes = lead[first] + 1  # of each distinct word, down to its trigger
    base = np.cumsum(suffixes) - suffixes
    owner = np.repeat(first, suffixes)
    shift = np.arange(len(owner)) - np.repeat(base, suffixes)
    _, suffix_rank = _ranked(_rows_of(text, start[owner] + shift, lead[owner] + k - shift, length))
    after = _rows_of(text, start + lead + k, many - 1 + length - lead - k, length - k)
    follow, follow_rank = _ranked(after)
    entry = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
    head, tail = suffix_rank[base[of[entry]] + place], follow_rank[entry]
    order = np.lexsort((tail, head))
    head, tail = head[order], tail[order]
    needed = (length - k - lead[entry] + place)[order]  # bytes of the continuation that the window has
    new = np.append(True, head[1:] != head[:-1])
    near = np.flatnonzero(~new & np.append(False, tail[1:] != tail[:-1]))
    for at in range(0, len(near), 100_000):
        i = near[at : at + 100_000]
        differ = (after[follow[tail[i]]] != after[follow[tail[i - 1]]]) & (np.arange(after.shape[1]) < needed[i][:, None])
        new[i] = differ.any(axis=1)
    return order, new


def sort_suffixes(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """One bucket of phrases: for each a bit for each window, set where an earlier document has it as well.

    As many triggers are sorted at a time as have about SORTED windows.
    """
    parts = [_split(p, "<u2", "<u2", "<u4", "id", "rest") for p in rows["payload"]]
    many, lead, core, doc, text = (np.concatenate([p[i] for p in parts]) for i in range(5))
    many, lead = many.astype(np.int64), lead.astype(np.int64)
    text = np.append(text, np.zeros(length, np.uint8))
    start = np.cumsum(many - 1 + length) - (many - 1 + length)
    flag_base = np.cumsum(many) - many
    order = np.argsort(core, kind="stable")
    core, reach = core[order], np.cumsum(many[order])
    flags, at = np.zeros(int(many.sum()), np.uint8), 0
    while at < len(order):
        stop = int(np.searchsorted(reach, (reach[at - 1] if at else 0) + min(SORTED, SORTED_BYTES // length), "right"))
        stop = int(np.searchsorted(core, core[min(max(stop, at + 1), len(core)) - 1], "right"))
        own = order[at:stop]
        ranked, new = _classes(text, start[own], lead[own], many[own], length)
        entry = np.repeat(own, many[own])
        window = flag_base[entry] + np.arange(len(entry)) - np.repeat(np.cumsum(many[own]) - many[own], many[own])
        owner = doc[entry[ranked]]
        earlier = np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1] < owner
        flags[window[ranked[earlier]]] = 1
        at = stop
    ends = np.cumsum([int(p[0].sum(dtype=np.int64)) for p in parts])
    return rows.assign(payload=[np.packbits(m).tobytes() for m in np.split(flags, ends[:-1])])


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) and the columns `keep` for each row of docs.

    Each byte of a whole text (UTF-8, null: empty) is removed that a string of `length` bytes (LONGEST at most) covers which also
    starts in a row with a smaller doc_id. kept is the rest as a string; parts of characters at a cut are
    left out of it (not of kept_sha256). Repeats inside a row and between rows of one doc_id stay. Rows with
    a null doc_id come before and after none: they stay whole. Texts shorter than `length` stay whole. The
    columns `keep` stay Arrow columns all along, so wide numbers beside nulls come back as they are.

    Rows are dealt to groups of about GROUP_BYTES by a hash of doc_id; only dictionaries of phrases, and the
    few phrases that have to be sorted, go to the buckets of their triggers, and answers of a byte, or a bit
    for each window, come back. The number of buckets grows with the groups.
    """
    if not 0 < length <= LONGEST:
        raise ValueError(f"length is 1 to {LONGEST}")
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *keep)
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    buckets = groups
    group = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(groups))
    # One shuffle serves all three uses below, so all of them take the same columns.
    placed = source.where("doc_id is not null").withColumn("_order", F.xxhash64("text")).withColumn("_group", group)
    said = "bucket bigint, g bigint, payload binary"

    def texts(part: pa.Table) -> pd.DataFrame:
        return part.select(["doc_id", "text", "_order"]).to_pandas()

    def sent(key: tuple, held: list[tuple[int, bytes]]) -> pa.Table:
        g = pa.array([key[0].as_py()] * len(held), pa.int64())
        return pa.table([pa.array([b for b, _ in held], pa.int64()), g, pa.array([p for _, p in held], pa.binary())], ["bucket", "g", "payload"])

    def ask(key: tuple, part: pa.Table) -> pa.Table:
        return sent(key, Parse(texts(part), length, buckets).requests())

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return compare_phrases(frame)

    def ask_again(key: tuple, part: pa.Table, rows: pa.Table) -> pa.Table:
        parse = Parse(texts(part), length, buckets)
        status = parse.answers(rows.select(["bucket", "payload"]).to_pandas(), "u1", np.uint8(NONE))
        return sent(key, [*parse.strings(status), (-1 - key[0].as_py(), status.tobytes())])  # the last goes back to this group as it is

    def sort(frame: pd.DataFrame) -> pd.DataFrame:
        return frame if frame["bucket"].iloc[0] < 0 else sort_suffixes(frame, length)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        frame = texts(left).assign(_row=np.arange(left.num_rows))
        rows = right.select(["bucket", "payload"]).to_pandas()
        parse = Parse(frame, length, buckets)
        own = rows["bucket"] < 0
        status = np.frombuffer(rows.loc[own, "payload"].iloc[0], np.uint8) if own.any() else np.zeros(len(parse.entry_core), np.uint8)
        gone = parse.covered(status, *parse.flags(status, dict(zip(rows["bucket"], rows["payload"], strict=True))))
        out = []
        for a, b in zip(parse.base, parse.base[1:], strict=False):
            off = gone[a:b]
            rest = parse.flat[a:b][~off].tobytes()
            runs = int(off[:1].sum() + np.count_nonzero(off[1:] & ~off[:-1]))
            out.append((int(b - a), int(off.sum()), runs, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
        held = left.take(pa.array(parse.frame["_row"].to_numpy())).select(["doc_id", *(f.name for f in extra)])
        new = list(zip(*out, strict=True)) if out else [[]] * 5
        for (name, kind), x in zip(_RESULT, new, strict=True):
            held = held.append_column(name, pa.array(x, kind))
        return held

    extra = [f for f in source.schema if f.name not in ("doc_id", "text")]
    schema = ", ".join(["doc_id bigint", *(f"`{f.name}` {f.dataType.simpleString()}" for f in extra), "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"])
    first = placed.groupBy("_group").applyInArrow(ask, said).groupBy("bucket").applyInPandas(compare, said)
    second = placed.groupBy("_group").cogroup(first.groupBy("g")).applyInArrow(ask_again, said).groupBy("bucket").applyInPandas(sort, said)
    out = placed.groupBy("_group").cogroup(second.groupBy("g")).applyInArrow(cut, schema)
    nothing = F.lit(0).cast("bigint")
    loose = source.where("doc_id is null").select(
        "doc_id",
        *keep,
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        nothing.alias("n_removed"),
        nothing.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        F.col("text").alias("kept"),
    )
    return out.unionByName(loose)
