"""Ranked lexical search, term at a time with limited accumulators.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. The documents become an index of shards: each shard
holds the postings of up to ``SHARD_DOCS`` documents for the terms that the items ask for, and is written by the task that read the texts. Postings meet the items'
terms by equality of the term; then each shard is searched for each block of items.

Within a shard an item's terms are taken rarest first. Every document met gets an accumulator until the sum of the best parts that the
remaining terms can add is below the k-th partial score: from then on no new accumulator is created, those that cannot reach the k-th score any
more are dropped, and the survivors go on to be updated exactly. The k best of each shard are ranked over all shards.

A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``; a document's part for it ``(10**9 tf) div (1000 tf + 20 m)`` with
``m = 50 + (50 n N) div L``; everything but the weight is in whole numbers.

Defined results: null and empty texts, and texts without a term, are found by nothing and count in no statistic; an item without terms, or whose terms are in
no document, has no rows, and neither has anything when a table is empty. Every row of the documents and of the items counts by itself: repeated rows are ranked each,
repeated item ids are answered each. Equal scores go by ascending id, null ids last. Texts of any length are read in pieces of about a
megabyte that end at a separator. Other columns are not read, and the four columns of the result have fixed names, so clashes cannot happen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from changeflow.llm.common import find_words, pieces, slices, span_hashes, text_bytes, written

SHARD_DOCS, SHARD_POSTINGS = 1 << 16, 1 << 21
BLOCK_ITEMS = 1024  # items, about, that search one shard in one task
SLOT_BITS = 22  # of the bitmap of asked terms: half a megabyte, whatever the number of items
_NO_TERM = np.ones(256, bool)
_NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def find_terms(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Lower-case bytes, and start, end and row of the terms, piece by piece."""
    for raw, offsets in pieces(*text_bytes(text), separator=_NO_TERM):
        raw = _LOWER[raw]
        yield raw, *find_words(raw, offsets, _NO_TERM)


def _strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """The given spans as an Arrow column."""
    sizes = ends - starts
    at = np.concatenate([[0], np.cumsum(sizes)])
    data = raw[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(number, item_id, term, slot): the distinct terms of every item; ``number`` tells rows of equal ids apart."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for raw, s, e, rows in find_terms(batch.column("text")):
                out = pa.table({"row": rows, "term": _strings(raw, s, e), "slot": _slots(span_hashes(raw, s, e))}).group_by(["row", "term", "slot"]).aggregate([])
                own = batch.select(["number", "item_id"]).take(out["row"].combine_chunks())
                yield from pa.table([*own.columns, out["term"].cast(pa.string()), out["slot"]], names=["number", "item_id", "term", "slot"]).combine_chunks().to_batches()

    narrow = items.select(F.monotonically_increasing_id().alias("number"), F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["item_id"].dataType.simpleString()
    return narrow.mapInArrow(split, f"number long, item_id {kind}, term string, slot long").distinct()


class _Shard:
    """Documents of one task and their postings."""

    def __init__(self):
        self.ids, self.sizes, self.keys, self.counts, self.code, self.docs, self.postings = [], [], [], [], {}, 0, 0

    def add(self, ids: pa.Array, text: pa.Array, asked: np.ndarray) -> None:
        sizes = np.zeros(len(ids), np.int64)
        for raw, s, e, rows in find_terms(text):
            sizes += np.bincount(rows, minlength=len(ids))
            hit = np.flatnonzero(asked[_slots(span_hashes(raw, s, e))])
            if not len(hit):
                continue
            own = _strings(raw, s[hit], e[hit]).dictionary_encode()
            codes = np.array([self.code.setdefault(t, len(self.code)) for t in own.dictionary.to_pylist()], np.int64)[own.indices.to_numpy()]
            keys, counts = np.unique(codes << 32 | (rows[hit] + self.docs), return_counts=True)
            self.keys.append(keys)
            self.counts.append(counts)
            self.postings += len(keys)
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.docs += len(ids)

    def rows(self, name: str, schema: pa.Schema) -> pa.RecordBatch:
        """One row per term, and one with a null term for the documents themselves: ids in ascending order, and their sizes."""
        ids = pa.chunked_array(self.ids).combine_chunks()
        order = pc.sort_indices(ids, sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        keys, counts = np.concatenate([*self.keys, np.zeros(0, np.int64)]), np.concatenate([*self.counts, np.zeros(0, np.int64)])
        keys = keys >> 32 << 32 | place[keys & 0xFFFFFFFF]
        by = np.argsort(keys, kind="stable")
        keys, counts = keys[by], counts[by]
        new = np.flatnonzero(np.diff(keys, prepend=-1))  # pieces of one long text meet here
        keys, counts = keys[new], np.add.reduceat(counts, new) if len(new) else counts
        terms = list(self.code)
        edges = np.searchsorted(keys >> 32, np.arange(len(terms) + 1))
        lists = lambda values, at: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))
        n = len(terms)
        docs = pa.concat_arrays([lists(keys & 0xFFFFFFFF, edges), lists([], [0, 0])])
        counts = pa.concat_arrays([lists(counts, edges), lists(np.concatenate(self.sizes)[order], [0, len(order)])])
        own = pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(ids)], pa.int32()), ids.take(pa.array(order)))
        return pa.RecordBatch.from_arrays([pa.array([name] * (n + 1)), pa.array([*terms, None], pa.string()), docs, counts, own.cast(schema.field("ids").type)], schema=schema)


def build_index(docs: DataFrame, asked: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, term, docs, counts, ids): postings of the terms whose slot is set in ``asked``; ``docs`` are places in the shard's documents.

    The row of a shard with a null term has all its ids, in ascending order, and their numbers of terms in ``counts``.
    """
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(asked))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(bits.value).astype(bool)
        part, number, shard, schema = TaskContext.get().partitionId(), 0, _Shard(), None
        for batch in slices(batches):
            ids = batch.column("id")
            schema = schema or pa.schema([("shard", pa.string()), ("term", pa.string()), ("docs", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("ids", pa.list_(ids.type))])
            shard.add(ids, batch.column("text"), asked)
            if shard.docs >= SHARD_DOCS or shard.postings >= SHARD_POSTINGS:
                yield shard.rows(f"{part}-{number}", schema)
                number, shard = number + 1, _Shard()
        if shard.docs:
            yield shard.rows(f"{part}-{number}", schema)

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(build, f"shard string, term string, docs array<int>, counts array<int>, ids array<{kind}>")


def best_documents(postings: Sequence[tuple[np.ndarray, np.ndarray]], size: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k documents of highest score (ties: smaller number first), their scores, and how many accumulators were created.

    postings: per term, rarest first, the documents (distinct) and what each gets for it. Scores are exact.
    """
    rest = [0]
    for _, parts in reversed(postings):
        rest.append(rest[-1] + int(parts.max()))
    rest.reverse()
    score, live, is_live = np.zeros(size, np.int64), None, None
    for i, (docs, parts) in enumerate(postings):
        if live is not None:
            hit = is_live[docs]
            docs, parts = docs[hit], parts[hit]
        score[docs] += parts
        beyond = rest[i + 1]
        held = score if live is None else score[live]
        if not beyond or len(held) < k or beyond >= held.max():
            continue
        kth = int(np.partition(held, -k)[-k])
        if beyond < kth:  # what has no accumulator yet cannot reach the k-th score
            live = np.flatnonzero(score) if live is None else live
            created = len(live) if is_live is None else created
            live = live[score[live] + beyond >= kth]
            is_live = np.zeros(size, bool)
            is_live[live] = True
    found = np.flatnonzero(score) if live is None else live[score[live] > 0]
    created = len(found) if is_live is None else created
    best = found[np.lexsort((found, -score[found]))[:k]]
    return best, score[best], created


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every row of ``items`` with a score above 0."""
    terms = written(item_terms(items, item_col, item_text_col), "lexical-terms")
    asked = np.zeros(1 << SLOT_BITS, bool)
    asked[[r[0] for r in terms.select("slot").distinct().collect()]] = True  # at most one row per slot
    index = written(build_index(docs, asked, id_col, text_col), "lexical-index")
    shards = index.where(F.col("term").isNull())
    n, total = shards.agg(F.sum(F.size(F.filter("counts", lambda c: c > 0))), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c))).first()
    n, total = n or 0, total or 0

    found_in = index.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    blocks = max(1, -(-terms.agg(F.count_distinct("number")).first()[0] // block_items))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).cast("long")
    use = F.struct("number", weight.alias("weight"), "df")
    asks = terms.join(found_in, "term").groupBy("term", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list(use).alias("uses"))
    postings = index.drop("ids").join(asks, "term").select("shard", "block", "docs", "counts", "uses", F.lit(None).cast(index.schema["ids"].dataType).alias("ids"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    own = shards.select("shard", every, "docs", "counts", F.lit(None).cast(postings.schema["uses"].dataType).alias("uses"), "ids")

    def best(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        at = group["uses"].is_null().to_pylist().index(True)
        ids = group["ids"][at].values
        m = np.array([50 + 50 * c * n // total if total else 50 for c in group["counts"][at].as_py()], np.int64)
        wanted: dict[int, list] = {}
        for i in range(group.num_rows):
            if i == at:
                continue
            docs, tf = group["docs"][i].values.to_numpy(), group["counts"][i].values.to_numpy().astype(np.int64)
            part = 1_000_000_000 * tf // (1000 * tf + 20 * m[docs])
            for use in group["uses"][i].as_py():
                wanted.setdefault(use["number"], []).append((use["df"], i, use["weight"], docs, part))
        out: list[tuple] = []
        for number, own in wanted.items():
            own.sort(key=lambda x: x[:2])
            found, scores, _ = best_documents([(docs, weight * part) for _, _, weight, docs, part in own], len(ids), k)
            out.append((number, found, scores))
        sizes = [len(f) for _, f, _ in out]
        return pa.table({
            "number": pa.array(np.repeat(np.array([x for x, _, _ in out], np.int64), sizes)),
            "doc_id": ids.take(pa.array(np.concatenate([np.zeros(0, np.int64), *(f for _, f, _ in out)]))),
            "score": pa.array(np.concatenate([np.zeros(0, np.int64), *(s for _, _, s in out)])),
        })

    kind = docs.schema[id_col].dataType.simpleString()
    scored = postings.unionByName(own).groupBy("shard", "block").applyInArrow(best, f"number long, doc_id {kind}, score long")
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.join(terms.select("number", "item_id").distinct(), "number").select("item_id", "rank", "doc_id", "score")
