"""Small numpy helpers that run inside Arrow tasks: text slices, word spans, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from themeloom.plans.session import workers_find_package

U64 = np.uint64
#: Odd base of the rolling polynomial and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches of whole texts small; a lower setting of the user stays."""
    workers_find_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = int(spark.conf.get(key))
    if held <= 0 or held > rows:
        spark.conf.set(key, str(rows))


def powers(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, U64)
        out[0] = 1
        np.cumprod(out, out=out)
        if size <= 1 << 23:
            _powers[base] = out
        held = out
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def byte_values(seed: int = 1) -> np.ndarray:
    """A pseudo-random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95) + U64(seed))


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * BASE**i, one longer than values."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), equal for equal content wherever it stands."""
    inv = powers(INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inv[start])


def spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.zeros(len(is_word) + 2, np.int8)
    edge[1:-1] = is_word
    at = np.flatnonzero(np.diff(edge))
    return at[0::2], at[1::2]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its len+1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j at a time, of about `limit` bytes: (i, j, bytes, offsets). A longer text comes alone and whole."""
    data, off = column_bytes(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def separated(data: np.ndarray, off: np.ndarray, by: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with one separator after each text, and where each text starts (and the end of all)."""
    return np.insert(data, off[1:], by), off + np.arange(len(off))


def byte_class(members: bytes | range | list) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


SPACE = byte_class([0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII letters and digits and all bytes of other characters.
ALNUM = byte_class([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
