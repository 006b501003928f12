"""Periodic runs of words: recompression gives a run-length grammar, whose extension queries make runs exact."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.kernel import U64, mix, small_batches

#: Bytes of text whose words share a grammar; a longer text has one alone.
SLICE = 1 << 20
#: Grid points that are looked at together.
POINTS = 1 << 20


class Level:
    """One level of a grammar: its symbols, and where the parts begin that are one symbol of the next level each.

    `blocks`: the parts are repetitions of one symbol; otherwise they are single symbols and pairs.
    """

    def __init__(self, symbols: np.ndarray, first: np.ndarray, blocks: bool):
        self.symbols, self.first, self.blocks, self.n = symbols, first, blocks, len(symbols)
        self.ended = np.append(symbols, -1)  # equal to no symbol
        self.parent = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.leads = np.append(first[self.parent] == np.arange(self.n), False)

    def mirrored(self) -> Level:
        return Level(self.symbols[::-1], self.n - self.first[::-1], self.blocks)

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.ended[a] == self.ended[b]

    def steps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray | int:
        """How far two places with the same symbol may move: in blocks by what both still have of it."""
        if not self.blocks:
            return 1
        return np.minimum(self.first[self.parent[a] + 1] - a, self.first[self.parent[b] + 1] - b)


def _numbered(head: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the pairs (head, rest), equal for equal pairs, and how many there are."""
    number, distinct = pd.factorize(head * (int(rest.max(initial=0)) + 2) + rest + 1)
    return number.astype(np.int64), len(distinct)


def grammar(symbols: np.ndarray) -> list[Level]:
    """Block and pair compression in turn until no symbol occurs twice.

    Pairs have a symbol of one half of the alphabet before one of the other; the halves are drawn by a hash,
    so that equal stretches are cut alike but for their ends. Equal symbols stand for equal stretches.
    """
    levels: list[Level] = []
    distinct, draw = len(np.unique(symbols)), 0
    while distinct < len(symbols):
        new = np.append(True, symbols[1:] != symbols[:-1])
        if not new.all():
            first = np.append(np.flatnonzero(new), len(symbols))
            levels.append(Level(symbols, first, True))
            symbols, distinct = _numbered(symbols[first[:-1]], np.diff(first))
            continue
        left = (mix(symbols.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(draw)) & U64(1)).astype(bool)
        draw += 1
        joined = np.append(False, left[:-1] & ~left[1:])
        if joined.any():
            first = np.append(np.flatnonzero(~joined), len(symbols))
            levels.append(Level(symbols, first, False))
            second = np.where(np.diff(first) == 2, symbols[np.minimum(first[:-1] + 1, len(symbols) - 1)], -1)
            symbols, distinct = _numbered(symbols[first[:-1]], second)
    levels.append(Level(symbols, np.arange(len(symbols) + 1), False))
    return levels


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols of the lowest level agree from each place a and each place b > a on.

    Places rise while both begin a symbol of the next level, so long agreements cost a few comparisons a
    level; where two symbols differ, their parts are compared on the way down.
    """
    begun, many = a, len(a)
    who, stopped = np.arange(many), [(np.zeros(0, np.int64),) * 3 for _ in levels]
    for h, level in enumerate(levels):
        risen, off = [], []
        while len(who):
            same = level.agree(a, b)
            off.append((who[~same], a[~same], b[~same]))
            who, a, b = who[same], a[same], b[same]
            up = level.leads[a] & level.leads[b] if h + 1 < len(levels) else np.zeros(len(who), bool)
            risen.append((who[up], level.parent[a[up]], level.parent[b[up]]))
            who, a, b = who[~up], a[~up], b[~up]
            step = level.steps(a, b)
            a, b = a + step, b + step
        if off:
            stopped[h] = tuple(np.concatenate([x[k] for x in off]) for k in range(3))
        who, a, b = (np.concatenate([x[k] for x in risen] or [np.zeros(0, np.int64)]) for k in range(3))
    who, a, b = (np.zeros(0, np.int64),) * 3
    for h in range(len(levels) - 1, -1, -1):
        level = levels[h]
        if h + 1 < len(levels):
            a, b = level.first[a], level.first[b]
        moving = np.flatnonzero(level.agree(a, b))
        while len(moving):
            step = level.steps(a[moving], b[moving])
            a[moving] += step
            b[moving] += step
            moving = moving[level.agree(a[moving], b[moving])]
        who, a, b = (np.concatenate([x, stopped[h][k]]) for k, x in enumerate((who, a, b)))
    out = np.zeros(many, np.int64)
    out[who] = a - begun[who]
    return out


def _grid(sizes: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grid over texts of ascending sizes that stand one after another.

    A run of period q agrees with itself q words on over max(least, exponent * q) - q places, so one in that
    many places is enough; texts that are too short for a period are passed over.
    """
    ends = np.cumsum(sizes)
    total, longest = int(ends[-1]), int(sizes[-1])
    at, width = 1, 256
    while at <= longest // exponent:
        q = np.arange(at, min(at + width, longest // exponent + 1))
        need = np.maximum(least, exponent * q)
        step = need - q
        fits = np.searchsorted(sizes, need)
        lowest = np.where(fits > 0, ends[np.maximum(fits, 1) - 1], 0)
        first = -(-lowest // step)
        count = np.maximum(0, -(-total // step) - first)
        reach = np.cumsum(count)
        if reach[-1] > POINTS and len(q) > 1:
            width = max(1, int(np.searchsorted(reach, POINTS)))
            continue
        period = np.repeat(q, count)
        inside = np.arange(len(period)) - np.repeat(reach - count, count)
        yield (np.repeat(first, count) + inside) * np.repeat(step, count), period
        at += len(q)
        width *= 2


def runs_of(symbols: np.ndarray, sizes: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """(start, length, period) of all runs of texts of ascending sizes, whose symbols are their own, by start."""
    none = np.zeros((0, 3), np.int64)
    if not len(symbols) or sizes[-1] < max(least, exponent):
        return none
    levels = back = None
    found, n = [none], len(symbols)
    for x, q in _grid(sizes, least, exponent):
        ok = x + q < n
        x, q = x[ok], q[ok]
        ok = symbols[x] == symbols[x + q]
        x, q = x[ok], q[ok]
        if not len(x):
            continue
        if levels is None:
            levels = grammar(symbols)
            back = [level.mirrored() for level in levels]
        before = extensions(back, n - x - q, n - x)
        size = before + extensions(levels, x, x + q) + q
        ok = size >= np.maximum(least, exponent * q)
        found.append(np.stack([x[ok] - before[ok], size[ok], q[ok]], 1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # The same stretch under a multiple of its smallest period is no run of its own.
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _some(texts: list[bytes], least: int, exponent: int) -> list[tuple[int, np.ndarray, bytes]]:
    """(words, runs, collapsed text) of each text."""
    words = [t.split() for t in texts]  # at ASCII white space
    order = sorted(range(len(texts)), key=lambda d: len(words[d]))
    sizes = np.array([len(words[d]) for d in order], np.int64)
    number = defaultdict(count().__next__)
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(words[d] for d in order)), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(order)), sizes)
    symbols, _ = _numbered(text, flat)
    runs = runs_of(symbols, sizes, least, exponent)
    base = np.cumsum(sizes) - sizes
    of = text[runs[:, 0]]
    cut = np.searchsorted(of, np.arange(len(order) + 1))
    out: list = [None] * len(order)
    for k, d in enumerate(order):
        own, kept = runs[cut[k] : cut[k + 1]].copy(), words[d]
        own[:, 0] -= base[k]
        if len(own):
            edge = np.zeros(len(kept) + 1, np.int64)
            np.add.at(edge, own[:, 0] + own[:, 2], 1)
            np.add.at(edge, own[:, 0] + own[:, 1], -1)
            kept = [kept[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
        out[d] = len(words[d]), own, b" ".join(kept)
    return out


def periodic_runs(docs: DataFrame, least: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) and the columns `keep` for each row of docs.

    Words are runs of other than ASCII white space. A run is a stretch of words of smallest period q, at least
    `least` and exponent * q words long, that no neighbouring word extends; runs: (start, length, period), by
    start, then period. collapsed has the words, joined by a space, that no run contains after its first
    q words. Each row is judged by itself: repeated rows alike, null, empty and blank texts have no words, no
    runs and an empty collapsed text; ids are not looked at, nulls stay. Nothing is shuffled. exponent is 2 at least.
    """
    if exponent < 2 or least < 2:
        raise ValueError("runs have two periods and two words at least")
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("_text"), *keep)
    extra = [f for f in source.schema if f.name not in ("doc_id", "_text")]
    schema = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    schema += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, at = [x or b"" for x in batch.column(1).to_pylist()], [], 0
            while at < len(texts):
                size, stop = len(texts[at]), at + 1
                while stop < len(texts) and size + len(texts[stop]) < SLICE:
                    size += len(texts[stop])
                    stop += 1
                rows += _some(texts[at:stop], least, exponent)
                at = stop
            many, runs, rest = zip(*rows, strict=True) if rows else ([], [], [])
            ends = np.cumsum([0, *map(len, runs)])
            flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            out = [batch.column(0), pa.array(many, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)]
            out += [pa.array(rest, pa.binary()).cast(pa.string()), *(batch.column(i) for i in range(2, batch.num_columns))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_words", "runs", "collapsed", *batch.schema.names[2:]])

    return source.mapInArrow(run, schema)
