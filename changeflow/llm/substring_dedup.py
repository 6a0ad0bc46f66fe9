"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words (runs outside space and 0x09-0x0D, unchanged). Its minimiser is the smallest hash of ``SEED`` consecutive words
in it. Consecutive windows of one document with the same minimiser form a super-k-mer, which travels as one packed string (its words
joined by one space) to the bucket of its minimiser; equal windows always meet there. A word goes if a window over it also starts in a document with
a smaller id.

1. Super-k-mers are listed with a hash of their words. Of equal ones only that of the smallest id is a representative; all windows of the others
   go. Copies, however many, are settled here, by one aggregation.
2. The representatives of minimisers with several different super-k-mers are packed. In each bucket sorting brings equal windows together, and
   the packed strings themselves confirm them.
3. A minimiser with more than ``HOT`` different super-k-mers is dealt out by window instead: 128-bit window hashes, aggregated before the
   shuffle and joined back.

Null texts have no words. Texts of fewer than ``WINDOW`` words lose none. Rows of one id are one document; a null id counts as larger than all
others. Repeated rows give repeated results: each (id, text) is listed about once a partition and packed once, and what goes is joined back to all its
rows. No result is lost by size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import find_words, mix64, power_tables, slices, span_hashes, text_bytes, written

WINDOW, SEED, HOT = 50, 8, 512
SEEN = 1 << 16  # documents that a task remembers to leave out repeated rows
_U = np.uint64
_STEP, _OTHER = _U(0xD6E8FEB86659FD93), _U(0xC2B2AE3D27D4EB4F)
_OTHER_INVERSE = _U(pow(int(_OTHER), -1, 1 << 64))


def _spans(words: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
    """Hashes of runs of words; ``second`` gives independent ones."""
    if second:
        words = mix64(words ^ _OTHER)
        up, down = power_tables(len(words) + 1, _OTHER, _OTHER_INVERSE)
    else:
        up, down = power_tables(len(words) + 1)
    total = np.zeros(len(words) + 1, _U)
    np.cumsum(words * up[:-1], dtype=_U, out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def super_kmers(words: np.ndarray, rows: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of every super-k-mer of the rows' words."""
    n, width = len(words), window - seed + 1
    if n < window:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.zeros(n - seed + 1, _U)
    for j in range(seed):
        grams = grams * _STEP + words[j : n - seed + 1 + j]
    grams = mix64(grams)
    full = np.full(-(-len(grams) // width) * width, ~_U(0), _U)
    full[: len(grams)] = grams
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: n - window + 1], ahead[width - 1 : width + n - window])
    at = np.flatnonzero(rows[: n - window + 1] == rows[window - 1 :])
    if not len(at):
        return np.zeros(0, _U), at, at
    least = least[at]
    first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)]))
    return least[first], at[first], np.diff(np.append(first, len(at)))


def _repeats_in_bucket(raw: np.ndarray, offsets: np.ndarray, order: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of words of the runs of windows that also stand in a row of smaller ``order``."""
    s, e, rows = find_words(raw, offsets)
    none = np.zeros(0, np.int64)
    if len(s) < window:
        return none, none, none
    words = span_hashes(raw, s, e)
    at = np.flatnonzero(rows[: len(s) - window + 1] == rows[window - 1 :])
    keys = _spans(words, at, at + window)
    owner = rows[at]
    by = np.lexsort((at, order[owner], keys))
    first = np.concatenate([[True], keys[by][1:] != keys[by][:-1]])
    lead = by[np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))]
    source = np.empty(len(at), np.int64)
    source[by] = lead
    gone = np.flatnonzero(order[owner] > order[owner[source]])
    if not len(gone):
        return none, none, none
    a, b = at[gone], at[source[gone]]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1) | (rows[a[1:]] != rows[a[:-1]]) | (rows[b[1:]] != rows[b[:-1]])]))
    count = np.diff(np.append(start, len(a)))
    text = raw.tobytes()
    a0, b0, last = a[start], b[start], count + window - 2
    for x, y, k in zip(a0.tolist(), b0.tolist(), last.tolist(), strict=True):
        if text[s[x] : e[x + k]] != text[s[y] : e[y + k]]:
            return _repeats_by_words(text, s, e, rows, order, window)  # two different windows share a hash
    row = rows[a0]
    return row, a0 - np.searchsorted(rows, row), count + window - 1


def _repeats_by_words(text: bytes, s: np.ndarray, e: np.ndarray, rows: np.ndarray, order: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_repeats_in_bucket``, window by window and without hashes of its own."""
    at = np.flatnonzero(rows[: len(s) - window + 1] == rows[window - 1 :]).tolist()
    cut = lambda x: text[s[x] : e[x + window - 1]]
    low: dict[bytes, int] = {}
    for x in at:
        low[cut(x)] = min(low.get(cut(x), int(order[rows[x]])), int(order[rows[x]]))
    gone = np.array([x for x in at if order[rows[x]] > low[cut(x)]], np.int64)
    return rows[gone], gone - np.searchsorted(rows, rows[gone]), np.full(len(gone), window)


def _seldom_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without rows whose (o, c) came before in this partition, as far as it is remembered; the rest is made distinct after the shuffle."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        take = []
        for i, key in enumerate(zip(batch.column("o").to_pylist(), batch.column("c").to_pylist(), strict=True)):
            if key in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(key)
            take.append(i)
        if take:
            yield batch if len(take) == batch.num_rows else batch.take(pa.array(take))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, kept (the words that stay, joined by one space) and kept_sha256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("o"), F.xxhash64(text).alias("c"), text.alias("text"))

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(_seldom_repeated(batches)):
            raw, offsets = text_bytes(batch.column("text"))
            s, e, row = find_words(raw, offsets)
            words = span_hashes(raw, s, e)
            k, at, n = super_kmers(words, row, window, seed)
            own = row[at]
            begin = np.searchsorted(row, np.arange(batch.num_rows))
            h = _spans(words, at, at + n + window - 1)
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(h.view(np.int64)), batch.column("o").take(take), batch.column("c").take(take), pa.array((at - begin[own]).astype(np.int32)), pa.array(n.astype(np.int32))], names=["k", "h", "o", "c", "at", "n"])

    runs = written(rows.select("o", "c", "text").mapInArrow(listing, "k long, h long, o long, c long, at int, n int"), "kmer-runs")
    equal = runs.groupBy("k", "h").agg(F.min("o").alias("low"), F.max("o").alias("high"))
    several = equal.groupBy("k").agg(F.count("*").alias("kinds"), F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select("k", "kinds")
    shared = written(equal.join(several, "k").select("k", "h", "low", (F.col("kinds") > 1).alias("mixed"), (F.col("kinds") > hot).alias("hot"), (F.col("low") < F.col("high")).alias("copied")), "kmer-shared")
    met = written(runs.join(shared.where("mixed or copied"), ["k", "h"]).select("o", "c", "at", "n", "k", "mixed", "hot", "low"), "kmer-met")
    copied = met.where("o > low").select("o", "c", "at", (F.col("n") + window - 1).alias("len"))
    heads = met.where("o = low and mixed").groupBy("o", "c").agg(F.collect_set(F.struct("k", "at", "n", "hot")).alias("runs"))

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, offsets = text_bytes(batch.column("text"))
            s, e, row = find_words(raw, offsets)
            begin = np.searchsorted(row, np.arange(batch.num_rows))
            lists = batch.column("runs")
            inner, own = lists.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at, n = inner.field("at").to_numpy(zero_copy_only=False), inner.field("n").to_numpy(zero_copy_only=False)
            a = begin[own] + at
            b = a + n + window - 2
            plain, size = _single_spaced(raw, s, e, row)
            moved = size[: len(s)]
            ends = moved + (e - s)
            packed = [plain[x:y] for x, y in zip(moved[a].tolist(), ends[b].tolist(), strict=True)]
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays([inner.field("k"), inner.field("hot"), batch.column("o").take(take), batch.column("c").take(take), inner.field("at"), pa.array(packed, pa.binary())], names=["k", "hot", "o", "c", "at", "packed"])

    some = rows.select("o", "c", "text").mapInArrow(_seldom_repeated, "o long, c long, text string")
    once = some.join(heads, ["o", "c"]).groupBy("o", "c").agg(F.first("text").alias("text"), F.first("runs").alias("runs"))
    packed = written(once.mapInArrow(packing, "k long, hot boolean, o long, c long, at int, packed binary"), "kmer-packed")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches, "k"):
            lens = pc.binary_length(batch.column("packed")).to_numpy()
            raw = np.frombuffer(b"".join(batch.column("packed").to_pylist()), np.uint8)
            row, at, size = _repeats_in_bucket(raw, np.concatenate([[0], np.cumsum(lens)]), batch.column("o").to_numpy(), window)
            if len(row):
                take = pa.array(row)
                first = batch.column("at").to_numpy()[row] + at
                yield pa.RecordBatch.from_arrays([batch.column("o").take(take), batch.column("c").take(take), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))], names=["o", "c", "at", "len"])

    dealt = packed.where("not hot").drop("hot").repartition("k").sortWithinPartitions("k")
    repeated = dealt.mapInArrow(buckets, "o long, c long, at int, len int")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            lens = pc.binary_length(batch.column("packed")).to_numpy()
            raw, offsets = np.frombuffer(b"".join(batch.column("packed").to_pylist()), np.uint8), np.concatenate([[0], np.cumsum(lens)])
            s, e, row = find_words(raw, offsets)
            words = span_hashes(raw, s, e)
            p = np.flatnonzero(row[: max(0, len(s) - window + 1)] == row[window - 1 :])
            own = row[p]
            first = batch.column("at").to_numpy()[own] + p - np.searchsorted(row, own)
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays([pa.array(_spans(words, p, p + window).view(np.int64)), pa.array(_spans(words, p, p + window, True).view(np.int64)), batch.column("o").take(take), batch.column("c").take(take), pa.array(first.astype(np.int32))], names=["w1", "w2", "o", "c", "at"])

    windows = packed.where("hot").mapInArrow(explode, "w1 long, w2 long, o long, c long, at int")
    lowest = windows.groupBy("w1", "w2").agg(F.min("o").alias("low"))
    dealt_out = windows.join(lowest, ["w1", "w2"]).where("o > low").select("o", "c", "at", F.lit(window).alias("len"))
    gone = copied.unionByName(repeated).unionByName(dealt_out).groupBy("o", "c").agg(F.collect_set(F.struct("at", "len")).alias("gone"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw, offsets = text_bytes(batch.column("text"))
            s, e, row = find_words(raw, offsets)
            begin = np.searchsorted(row, np.arange(batch.num_rows))
            lists = batch.column("gone")
            inner, own = lists.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False))
            cover = np.zeros(len(s) + 1, np.int64)
            a = begin[own] + inner.field("at").to_numpy(zero_copy_only=False)
            np.add.at(cover, a, 1)
            np.add.at(cover, a + inner.field("len").to_numpy(zero_copy_only=False), -1)
            stay = np.cumsum(cover[:-1]) == 0
            plain, size = _single_spaced(raw, s[stay], e[stay], row[stay])
            count, left = np.bincount(row, minlength=batch.num_rows), np.bincount(row[stay], minlength=batch.num_rows)
            edge = np.concatenate([[0], np.cumsum(left)])
            kept = [plain[size[x] : size[y] - (y > x and y < edge[-1])] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(count, pa.int64()), pa.array(count - left, pa.int64()), pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], names=["id", "n_words", "n_removed", "kept", "kept_sha256"])

    joined = rows.join(gone, ["o", "c"], "left").select("id", "text", "gone")
    return joined.mapInArrow(keep, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_removed long, kept string, kept_sha256 string").withColumnRenamed("id", id_col)


def _single_spaced(raw: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words one after another, each but the very last followed by one space, and where each starts (one more entry for the end)."""
    size = (e - s) + 1
    if len(size):
        size[-1] -= 1
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.full(int(start[-1]), 0x20, np.uint8)
    if len(s):
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[s] += 1
        inside[e] -= 1
        target = np.zeros(len(out) + 1, np.int8)
        target[start[:-1]] += 1
        target[start[:-1] + (e - s)] -= 1
        out[np.cumsum(target[:-1], dtype=np.int8).astype(bool)] = raw[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    return out.tobytes(), start


def _whole_groups(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches, ordered by a column, cut and joined so that no value is split; several values come together up to about ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        key, lens = batch.column(column).to_numpy(), pc.binary_length(batch.column("packed")).to_numpy()
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if held and size > limit and held[-1].column(column)[-1].as_py() != key[a]:
                yield joined()
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            size += int(lens[a:b].sum())
    if held:
        yield joined()
