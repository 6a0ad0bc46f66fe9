"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters, marks and digits by Unicode class, in lower case; each character of a script written without spaces (``UNSPACED``) and each
symbol beyond ASCII is a token of its own, and all punctuation separates. Karp-Rabin hashes of ``MIN_MATCH`` tokens of the documents are looked up among those of
the benchmark items. Matches of k tokens or more that cover n tokens of an item hold at least n / k of its seeds, so an item needs that many of them in a
document, and one at least outside its most frequent ones: only these seeds find pairs, frequent seeds just count for pairs that are found.
The hits of a pair chain into maximal matches along diagonals, or, where repetitive texts make too many hits, follow from run lengths along the
document, one item token after the other. For each such pair of document and item the longest match without marked
tokens is marked again and again (parts of a match that are marked already are cut off), until none of ``MIN_MATCH`` tokens is left. An item is
found in a document when the marked tokens are at least ``COVERAGE`` of the item, in whatever order its passages stand.

Items of fewer than ``MIN_MATCH`` but at least ``shortest`` tokens are found where all their tokens stand in a row; the tile is the first such place.

The benchmark is read in blocks of bounded size; each is sent to the tasks, and is one more step of the one pass over the documents.

Defined results: null and empty texts contain nothing; an empty table gives an empty result, and an empty benchmark empty lists; items without tokens, or with fewer than ``shortest``, cannot be found; equal items are both
reported; rows are judged one by one, so repeated rows and null ids get their own result. All columns of the documents come back; a column that has the name of the
result is replaced. A text of any length is one slice, which takes some 60 bytes of memory a token.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import gram_hashes, slices, span_hashes, text_bytes

MIN_MATCH, COVERAGE = 4, 0.5
BLOCK_TOKENS = 1 << 21  # tokens of items in one broadcast block, about 50 MB
_U = np.uint64
_TOKEN = np.zeros(256, np.uint8)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_JOINERS = (0x200C, 0x200D)  # inside words of Persian and Indic scripts
#: First and last character of the blocks of scripts without spaces: Thai, Lao; Myanmar; Khmer; Tai Le to Tai Tham; Balinese; Han and kana; Yi; Javanese,
#: Myanmar; Cham to Tai Viet; compatibility ideographs; half-width kana; Ahom; cuneiform, hieroglyphs; Tangut to kana; Nushu; further Han.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF),
    (0xAA00, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x11700, 0x1174F), (0x12000, 0x1467F), (0x16FE0, 0x1B16F), (0x1B170, 0x1B2FF), (0x20000, 0x3FFFF),
)
_FILTER_BITS = 20
MOST_HITS = 1 << 20  # seed hits of one pair, or candidates of one slice, that are listed at once
MATCHES = "array<struct<item_id: {id}, coverage: double, tiles: array<struct<doc_start: int, item_start: int, length: int>>>>"


@cache
def _classes() -> np.ndarray:
    """Per code point: 0 separates, 1 stands inside words, 2 is a token of its own. What Unicode has not assigned counts as a letter."""
    of = {"L": 1, "M": 1, "N": 1, "Co": 1, "Cn": 1, "Sm": 2, "Sc": 2, "So": 2}
    names = [unicodedata.category(chr(c)) for c in range(0x40000)]
    kind = np.ones(0x110000, np.uint8)
    kind[:0x40000] = [of.get(n, of.get(n[0], 0)) for n in names]
    for a, b in UNSPACED:
        own = [c for c in range(a, b + 1) if names[c][0] in "LM" or names[c] in ("Nl", "Cn")]
        kind[own] = 2
    kind[list(_JOINERS)] = 1
    kind[0xE0000:0xE0080] = 0  # tags
    return kind


def _kinds(raw: np.ndarray) -> np.ndarray:
    """The class of every byte's character."""
    kind = _TOKEN[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        first, size = raw[lead].astype(np.int32), 2 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0)
        code = first & (0x7F >> size)
        for j in range(1, 4):
            more = size > j
            at = np.minimum(lead[more] + j, len(raw) - 1)
            code[more] = (code[more] << 6) | (raw[at] & 0x3F)
        own = _classes()[np.minimum(code, 0x10FFFF)]
        kind[lead] = own
        for j in range(1, 4):
            more = (size > j) & (lead + j < len(raw))
            kind[lead[more] + j] = own[more]
    return kind


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every token."""
    if not len(raw):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    kind = _kinds(raw)
    inside = kind > 0
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    alone = (kind[1:] == 2) | (kind[:-1] == 2)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1] | alone & ((raw[1:] & 0xC0) != 0x80)
    ends[:-1] &= ~inside[1:] | starts[1:]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return span_hashes(raw, s, e), np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(s, offsets)))


@dataclass
class Items:
    """A block of benchmark items: their tokens and seeds, and the seeds that find them."""

    ids: list
    tokens: np.ndarray
    starts: np.ndarray  # of the items' tokens, one more than items
    seeds: np.ndarray  # distinct, sorted
    own: np.ndarray  # numbers of the items' seeds, item by item
    own_starts: np.ndarray
    needed: np.ndarray  # seeds of an item that a document must hold
    finds: np.ndarray  # items by the number of a seed that finds them
    finds_starts: np.ndarray
    table: np.ndarray  # whether a seed with these leading bits exists
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # of the items of fewer tokens than a seed, by their number: hashes, sorted, and items

    @classmethod
    def of(cls, ids: list, texts: list[str], k: int, shortest: int | None = None, coverage: float = COVERAGE) -> "Items":
        raw, offsets = text_bytes(pa.array(texts, pa.string()))
        words, rows = tokens(raw, offsets)
        grams, at = gram_hashes(words, rows, k)
        starts = np.searchsorted(rows, np.arange(len(ids) + 1))
        table = np.zeros(1 << _FILTER_BITS, bool)
        table[(grams >> _U(64 - _FILTER_BITS)).astype(np.int64)] = True
        seeds, own = np.unique(grams, return_inverse=True)
        own_starts = np.searchsorted(rows[at], np.arange(len(ids) + 1))
        needed = np.maximum(1, np.ceil(coverage * np.diff(starts) / k - 1e-9)).astype(np.int64)
        # per item its seeds from the rarest on, without the needed - 1 most frequent
        item, often = rows[at], np.bincount(own, minlength=len(seeds))[own]
        by = np.lexsort((often, item))
        place = np.arange(len(by)) - own_starts[item[by]]
        finder = by[place <= (np.diff(own_starts) - needed)[item[by]]]
        finder = finder[np.argsort(own[finder], kind="stable")]
        short = {}
        for n in range(max(1, k if shortest is None else shortest), k):
            whole, first = gram_hashes(words, rows, n)
            whole, short_item = whole[np.diff(starts)[rows[first]] == n], rows[first][np.diff(starts)[rows[first]] == n]
            if len(short_item):
                by = np.argsort(whole, kind="stable")
                short[n] = whole[by], short_item[by]
        return cls(ids, words, starts, seeds, own, own_starts, needed, item[finder], np.searchsorted(own[finder], np.arange(len(seeds) + 1)), table, short)


def tile(starts: np.ndarray, item_starts: np.ndarray, lengths: np.ndarray, item_size: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of maximal matches: the marked tiles as (doc_start, item_start, length)."""
    order = np.lexsort((item_starts, starts, -lengths))
    order = order[lengths[order] >= least]
    parts: list[tuple[int, int, int]] = []  # unmarked parts of matches, as (-length, doc_start, item_start)
    in_doc: set[int] = set()
    in_item = np.zeros(item_size, bool)
    tiles, marked, at = [], 0, 0
    while (at < len(order) or parts) and item_size - marked >= least:
        whole = (-int(lengths[order[at]]), int(starts[order[at]]), int(item_starts[order[at]])) if at < len(order) else None
        if parts and (whole is None or parts[0] < whole):
            n, d, i = heapq.heappop(parts)
        else:
            (n, d, i), at = whole, at + 1
        n = -n
        if in_item[i : i + n].all():
            continue
        free = [not in_item[i + x] and d + x not in in_doc for x in range(n)]
        if all(free):
            in_item[i : i + n] = True
            in_doc.update(range(d, d + n))
            tiles.append((d, i, n))
            marked += n
            continue
        x = 0
        while x < n:  # unmarked parts go back
            if not free[x]:
                x += 1
                continue
            y = x
            while y < n and free[y]:
                y += 1
            if y - x >= least:
                heapq.heappush(parts, (x - y, d + x, i + x))
            x = y
    return sorted(tiles)


def _short_matches(items: Items, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, tuple]]:
    """Row and found item for the items that are shorter than a seed; all their tokens stand in the row."""
    for n, (whole, item) in items.short.items():
        grams, at = gram_hashes(words, rows, n)
        low = np.searchsorted(whole, grams, "left")
        hit = np.flatnonzero(whole[np.minimum(low, len(whole) - 1)] == grams)
        at, low = at[hit], low[hit]
        _, once = np.unique(np.stack([rows[at], low]), axis=1, return_index=True)  # the first place of each
        for p, x in zip(at[once].tolist(), low[once].tolist(), strict=True):
            place = p - int(np.searchsorted(rows, rows[p]))
            for y in item[x : np.searchsorted(whole, whole[x], "right")].tolist():
                yield int(rows[p]), (items.ids[y], 1.0, [(place, 0, n)])


def _spread(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the given lists, and which list each belongs to."""
    n = starts[which + 1] - starts[which]
    return np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), np.repeat(np.arange(len(which)), n)


def _chunks(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices whose sizes sum to about ``most``."""
    if not len(sizes):
        return
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // most, prepend=-1)).tolist()
    for a, b in zip(edges, [*edges[1:], len(sizes)], strict=True):
        yield slice(a, b)


def _pairs(items: Items, row: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row and item that share enough seeds. row, seed: the distinct hits, in order of row."""
    n = len(items.ids)
    found = [np.zeros(0, np.int64)]
    for part in _chunks(np.diff(items.finds_starts)[seed] + 1, MOST_HITS):
        places, of = _spread(items.finds_starts, seed[part])
        found.append(np.unique(row[part][of] * n + items.finds[places]))
    pairs = np.unique(np.concatenate(found))
    hits, keep = row * len(items.seeds) + seed, []
    for part in _chunks(np.diff(items.own_starts)[pairs % n] + 1, MOST_HITS):
        places, of = _spread(items.own_starts, pairs[part] % n)
        key = (pairs[part] // n)[of] * len(items.seeds) + items.own[places]
        held = hits[np.minimum(np.searchsorted(hits, key), len(hits) - 1)] == key
        keep.append(np.bincount(of[held], minlength=len(pairs[part])) >= items.needed[pairs[part] % n])
    pairs = pairs[np.concatenate(keep)] if keep else pairs
    return pairs // n, pairs % n


def maximal_matches(doc: np.ndarray, item: np.ndarray, doc_at: np.ndarray, item_at: np.ndarray, doc_seed: np.ndarray, item_seed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_start, item_start, length) of all matches of k tokens or more that go no further on either side.

    doc, item: tokens; *_at, *_seed: places and numbers of their seeds, the document's only where the item has them too.
    """
    by = np.argsort(item_seed, kind="stable")
    low, high = np.searchsorted(item_seed[by], doc_seed, "left"), np.searchsorted(item_seed[by], doc_seed, "right")
    if int((high - low).sum()) > MOST_HITS:
        return _run_matches(doc, item, doc_at, k)
    edges = np.concatenate([[0], np.cumsum(high - low)])
    of = np.repeat(np.arange(len(doc_at)), high - low)
    i, j = doc_at[of], item_at[by][low[of] + np.arange(edges[-1]) - edges[of]]
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(i - j) != 0) | (np.diff(i) != 1)])[: len(i)])
    return i[new], j[new], np.diff(np.append(new, len(i))) + k - 1


def _run_matches(doc: np.ndarray, item: np.ndarray, doc_at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``maximal_matches`` in memory that grows with the document alone: lengths of the runs that end at every place, for one item token after the other."""
    some = np.zeros(len(doc) + 1, bool)
    for x in range(k):
        some[doc_at + x] = True
    place = np.flatnonzero(some)
    here, joined = doc[place], np.diff(place, prepend=-2) == 1
    run, out = np.zeros(len(place), np.int64), []
    for j in range(len(item) + 1):
        same = here == item[j] if j < len(item) else np.zeros(len(here), bool)
        goes_on = np.append((same & joined)[1:], False)
        ended = np.flatnonzero((run >= k) & ~goes_on)
        if len(ended):
            out.append((place[ended] - run[ended] + 1, j - run[ended], run[ended]))
        before = np.where(joined, np.concatenate([[0], run[:-1]]), 0)
        run = np.where(same, before + 1, 0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _matches(items: Items, words: np.ndarray, rows: np.ndarray, k: int, coverage: float) -> dict[int, list]:
    """Per row of a slice: its found items as (item, coverage, tiles)."""
    out: dict[int, list] = {}
    for r, found in _short_matches(items, words, rows):
        out.setdefault(r, []).append(found)
    grams, at = gram_hashes(words, rows, k)
    at = at[maybe] if len(maybe := np.flatnonzero(items.table[(grams >> _U(64 - _FILTER_BITS)).astype(np.int64)])) else at[:0]
    if not len(at) or not len(items.seeds):
        return out
    grams = grams[maybe]
    seed = np.minimum(np.searchsorted(items.seeds, grams), len(items.seeds) - 1)
    hit = items.seeds[seed] == grams
    at, seed = at[hit], seed[hit]
    if not len(at):
        return out
    distinct = np.unique(rows[at] * len(items.seeds) + seed)
    of_row = np.searchsorted(rows[at], np.arange(rows[-1] + 2))  # hits of each row
    first = np.searchsorted(rows, np.arange(rows[-1] + 2))
    for r, x in zip(*(p.tolist() for p in _pairs(items, distinct // len(items.seeds), distinct % len(items.seeds))), strict=True):
        own, item = items.own[items.own_starts[x] : items.own_starts[x + 1]], items.tokens[items.starts[x] : items.starts[x + 1]]
        doc_at, doc_seed = at[of_row[r] : of_row[r + 1]] - first[r], seed[of_row[r] : of_row[r + 1]]
        both = np.isin(doc_seed, own)
        tiles = tile(*maximal_matches(words[first[r] : first[r + 1]], item, doc_at[both], np.arange(len(own)), doc_seed[both], own, k), len(item), k)
        share = sum(n for _, _, n in tiles) / len(item)
        if share >= coverage:
            out.setdefault(r, []).append((items.ids[x], share, tiles))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, k: int, block_tokens: int, shortest: int, coverage: float) -> Iterator[Items]:
    """The benchmark in blocks of bounded size."""
    ids, texts, held = [], [], 0
    for r in benchmark.select(F.col(id_col), F.lower(F.coalesce(F.col(text_col), F.lit("")))).toLocalIterator():
        size = len(r[1]) // 2 + 1 if r[1].isascii() else len(r[1])  # tokens at most
        if ids and held + size > block_tokens:
            yield Items.of(ids, texts, k, shortest, coverage)
            ids, texts, held = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        held += size
    if ids:
        yield Items.of(ids, texts, k, shortest, coverage)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", matches_col: str = "matches", min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_tokens: int = BLOCK_TOKENS, shortest: int = MIN_MATCH) -> DataFrame:
    """All rows and columns of ``docs`` with ``matches``: the items found, their coverage, and the tiles (token positions).

    The documents are read once and not shuffled; each block of items is broadcast and is one more step of the same pass.
    """
    sc, columns = docs.sparkSession.sparkContext, docs.columns
    kind = MATCHES.format(id=benchmark.schema[item_col].dataType.simpleString())
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join([*(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True)), "__lower string", f"__matches {kind}"])
    out = docs.toDF(*names).withColumn("__lower", F.lower(F.coalesce(F.col(names[columns.index(text_col)]), F.lit("")))).withColumn("__matches", F.array().cast(kind))

    def step(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "__lower"):
                words, rows = tokens(*text_bytes(batch.column("__lower")))
                found = _matches(shared.value, words, rows, min_match, coverage) if len(words) else {}
                if found:
                    lists = batch.column("__matches").to_pylist()
                    for row, hits in found.items():
                        lists[row] = lists[row] + [{"item_id": i, "coverage": c, "tiles": [{"doc_start": d, "item_start": s, "length": n} for d, s, n in t]} for i, c, t in hits]
                    batch = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lists, batch.column("__matches").type)], schema=batch.schema)
                yield batch

        return run

    for items in _blocks(benchmark, item_col, item_text_col, min_match, block_tokens, shortest, coverage):
        out = out.mapInArrow(step(sc.broadcast(items)), schema)
    kept = [(n, c) for n, c in zip(names, columns, strict=True) if c.lower() != matches_col.lower()]
    return out.select(*(n for n, _ in kept), "__matches").toDF(*(c for _, c in kept), matches_col)
