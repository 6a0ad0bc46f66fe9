"""Shared helpers: words and hashes of whole Arrow columns in numpy, bounded slices of batches, written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from changeflow.scratch import shared_path

SLICE_BYTES = 1 << 20  # text worked on at once; a longer text is a slice by itself

_U = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def power_tables(n: int, base: np.uint64 = _BASE, inverse: np.uint64 = _INVERSE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if base is _BASE and len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    out = []
    for b in (base, inverse):
        steps = np.full(n, b, _U)
        steps[:1] = 1
        out.append(np.cumprod(steps, dtype=_U))
    if base is _BASE and n <= 4 * SLICE_BYTES:
        _powers[:] = out
    return out[0], out[1]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts take about ``limit`` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a + 1 and sizes[b - 1] > limit:  # the long text that ended the block goes alone
                yield batch.slice(a, b - 1 - a)
                a = b - 1
            yield batch.slice(a, b - a)


def find_words(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes outside ``separator`` (space and 0x09-0x0D); runs end at the row's edges."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~separator[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(s, offsets)))


def pieces(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A slice's bytes and offsets; a text above twice the limit, which is a slice by itself, in pieces that end at separators."""
    if len(offsets) != 2 or len(raw) <= 2 * limit:
        yield raw, offsets
        return
    at = 0
    while at < len(raw):
        end = at + limit
        while end < len(raw):
            gap = np.flatnonzero(separator[raw[end : end + limit]])
            if len(gap):
                end += int(gap[0])
                break
            end += limit
        end = min(end, len(raw))
        yield raw[at:end], np.array([0, end - at])
        at = end


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by a running polynomial over all bytes."""
    up, down = power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum(_BYTE[raw] * up[:-1], dtype=_U, out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def gram_hashes(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one row, with the position of the first; a row of fewer than k words gives none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    out = np.zeros(n, _U)
    for j in range(k):
        out = out * _BASE + words[j : n + j]
    return mix64(out[at]), at


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it again: later steps survive lost executors and nothing is computed twice."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sample_share(*columns, seed: int = 0):
    """A number from 0 to 1 that depends on the columns alone, the same in every run."""
    return (F.xxhash64(*columns, F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).cast("double")
