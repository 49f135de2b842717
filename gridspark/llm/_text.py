"""Vectorised helpers over the UTF-8 bytes of Arrow string columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 20
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers in place, one to one."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> U64(shift)
        h *= U64(factor)
    h ^= h >> U64(31)
    return h


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


def folded_values() -> np.ndarray:
    """Byte values under which ASCII letters hash alike in either case."""
    values = BYTE_VALUES.copy()
    values[65:91] = values[97:123]
    return values


def separators_but_letters() -> np.ndarray:
    """True for ASCII bytes that are neither letter nor digit; bytes of other characters belong to words."""
    sep = np.ones(256, bool)
    sep[48:58] = sep[65:91] = sep[97:123] = sep[128:] = False
    return sep


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i = 0..n-1."""
    out = []
    for factor in (BASE, INVERSE):
        p = np.full(n, factor, U64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def power(factor: int, exponent: int) -> np.uint64:
    return U64(pow(factor, exponent, 1 << 64))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of the rows); a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = ASCII_SPACE,
          values: np.ndarray = BYTE_VALUES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row: (start bytes, end bytes, 64-bit hashes, first word of each row and the total).

    A word is a longest run of bytes that are not `gap`, inside one row. Works block by block, so memory stays
    proportional to the number of words however long a row is.
    """
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    up, down = powers(BLOCK)
    total = U64(0)
    parts: list[tuple] = []
    for p in range(0, n, BLOCK):
        block = data[p:p + BLOCK]
        m = len(block)
        solid = ~gap[block]
        before = np.empty(m, bool)
        before[0], before[1:] = p > 0 and not gap[data[p - 1]], solid[:-1]
        after = np.empty(m, bool)
        after[-1], after[:-1] = p + m < n and not gap[data[p + m]], solid[1:]
        s = np.flatnonzero(solid & (~before | edge[p:p + m]))
        e = np.flatnonzero(solid & (~after | edge[p + 1:p + m + 1])) + 1
        run = np.zeros(m + 1, U64)
        np.cumsum(values[block] * down[:m], out=run[1:])
        run *= power(INVERSE, p)
        run += total
        parts.append((s + p, e + p, run[s], run[e], up[s] * power(BASE, p)))
        total = run[m]
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, U64), np.zeros(len(offsets), np.int64)
    starts, ends, left, right, scale = (np.concatenate(x) for x in zip(*parts))
    return starts, ends, mix((right - left) * scale), np.searchsorted(starts, offsets)


def row_slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most `size` bytes, or of one row."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, rows)
        lo = hi


def release() -> None:
    """Return freed memory to the system (with glibc all of it)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """`work`, at whose end the worker, which Spark uses again, returns freed memory to the system."""
    @wraps(work)
    def run(*args, **options) -> Iterator[pa.RecordBatch]:
        yield from work(*args, **options)
        release()

    return run


def parquet(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
