"""Exact top-k inner products by a vector-approximation file.

Components become integers floor(scale * x). Every vector has an approximation: per component the number of a cell between equally spaced borders,
one byte each. Vectors lie in packs of up to ``PACK`` with their approximations beside them. For a pack and a block of queries the cells give upper
bounds of all scores; only vectors whose bound reaches a query's k-th best score so far are read exactly. A query without k scores first
reads the ``CHUNK`` vectors of the highest bounds. Equal vectors of a pack are held once, with the ids of their 2k smallest rows, of one id at most k, so
ties cost no extra reads and lose nothing: without the rows of any one id, the query's own, the k smallest others remain. The best k of all tasks
are merged per query.

Bounds come from one matrix product of small whole numbers: a query, times the cell widths, is rounded so that its product with any cell numbers stays
within ``LEVEL``. Three vectors share one double, and each of its three fields of ``BITS`` bits gets the query's limit taken off, so that the field's highest bit
says whether the bound reaches the k-th best score. The limit allows for all that cells and rounding can hide. Where more than one vector in ``MANY``
reaches the limit, and where vectors are too long for such numbers, the exact scores of the whole pack are taken, as a matrix product in the narrowest
type that holds them without rounding.

Queries are themselves a share of all rows, so they come in blocks of about ``QUERY_BLOCK``, up to ``GROUP`` blocks in a group, and packs in shards: few
long ones, since a block meets the first packs of each shard without good k-th scores, and so at least ``GROUPS`` groups. A task holds the
blocks of one group and passes the packs of one shard by them one at a time, so a query's k-th best score holds for all later packs of the shard. No side is
broadcast; packs move once per group of queries, queries once per shard.

Vectors that are null or empty, or hold null, NaN or infinite components, and rows with a null id take no part; scores exist between vectors of equal
length. A repeated row is one query, but each of its rows is a candidate. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from changeflow.llm.common import written

PACK, QUERY_BLOCK = 4096, 1024
CELLS = 256  # per component
CHUNK = 32  # exact vectors read first by one query
GROUP, GROUPS, WORK = 256, 3, 1 << 15  # blocks in a group at most; groups at least; pairs of a block and a pack in a task, about
MANY, ROWS = 32, 256  # a query that must read a larger part of a pack takes all of it; queries in one product
FIELDS, BITS = 3, 17  # of a double's 52 bits
LEVEL = 1 << BITS - 2  # of a field: the largest product of a rounded query and cell numbers
WAIT = 15  # packs at most for which a block goes without bounds after they were of little use
_EACH = float(sum(1 << BITS * i for i in range(FIELDS)))  # one in every field
_REACHED = np.int64(sum(1 << BITS * i + BITS - 1 for i in range(FIELDS)))  # the highest bit of every field
_NONE, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max  # score and id of a place that is not taken


def _narrow(v: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as they all fit."""
    most = max(-int(v.min(initial=0)), int(v.max(initial=0)))
    return v.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if most <= np.iinfo(t).max or t == "<i8"))


def _packs(rows: DataFrame, size: int, k: int, scale: int) -> DataFrame:
    """One row per pack of the rows (id, raw, asked): distinct integer vectors, the ids of each (the 2k smallest, one id at most k), cell borders and
    cell numbers, the largest component and distance from the middle of a cell; and the rows that are queries."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, vectors, asked = 0, [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal number, ids, vectors, asked
            id_, x, ask = np.concatenate(ids), np.concatenate(vectors), np.concatenate(asked)
            most = min(float(np.abs(x).max()), 2.0**63)
            v = np.clip(x, -(2.0**63), 2.0**63 - 1024).astype("<i8")
            ask_id, ask_v = id_[ask].astype("<i8"), v[ask]
            same = np.unique(v.view(f"V{8 * v.shape[1]}").ravel(), return_inverse=True)[1]
            order = np.lexsort((id_, same))
            id_, v, same = id_[order], v[order], same[order]
            first = np.concatenate([[True], same[1:] != same[:-1]])
            group = np.cumsum(first) - 1
            start = np.flatnonzero(first)
            v = v[start]
            same = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (id_[1:] != id_[:-1])]))
            few = np.arange(len(id_)) - np.repeat(same, np.diff(np.append(same, len(id_)))) < k  # of one id
            id_, group = id_[few], group[few]
            held = np.arange(len(id_)) - np.searchsorted(group, group) < 2 * k  # up to k of them may be the query's own
            low, high = v.min(axis=0), v.max(axis=0)
            width = np.maximum(1, -(-(high - low + 1) // CELLS))
            cells = ((v - low) // width).astype(np.uint8)
            error = np.sqrt(((v - (low + cells * width + (width - 1) / 2)) ** 2).sum(axis=1).max())
            row = pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() * 65_536 + number], pa.int64()), pa.array([v.shape[1]], pa.int32()), pa.array([most]), pa.array([float(error)]), pa.array([len(ask_id)], pa.int64())]
                + [pa.array([x.tobytes()], pa.binary()) for x in (_narrow(v), cells, low.astype("<i8"), width.astype("<i8"), id_[held].astype("<i8"), group[held].astype("<i4"), ask_id, ask_v)],
                names=["pack", "dims", "most", "error", "asked", "vectors", "cells", "low", "width", "ids", "owner", "asked_ids", "asked_vectors"],
            )
            number, ids, vectors, asked = number + 1, [], [], []
            return row

        for batch in batches:
            raw = batch.column("raw")
            at, x = raw.offsets.to_numpy(), raw.flatten().to_numpy(zero_copy_only=False)
            at = at - at[0]
            wrong = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            sizes = np.where(wrong[at[1:]] > wrong[at[:-1]], 0, np.diff(at))
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(x * scale)
            id_, ask = batch.column("id").to_numpy(zero_copy_only=False), batch.column("asked").to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes[sizes > 0]):
                part = np.flatnonzero(sizes == dims)
                if vectors and vectors[0].shape[1] != dims:
                    yield flush()
                for a in range(0, len(part), size):
                    piece = part[a : a + size]
                    ids.append(id_[piece])
                    vectors.append(x[at[piece][:, None] + np.arange(dims)])
                    asked.append(ask[piece])
                    if sum(map(len, ids)) >= size:
                        yield flush()
        if ids:
            yield flush()

    schema = "pack long, dims int, most double, error double, asked long, vectors binary, cells binary, low binary, width binary, ids binary, owner binary, asked_ids binary, asked_vectors binary"
    return rows.mapInArrow(pack, schema)


class _Pack:
    """A pack's vectors, and its cell numbers as they enter products, three vectors in one number."""

    def __init__(self, row: dict):
        dims = row["dims"]
        self.n = n = len(row["cells"]) // dims
        self.exact = np.frombuffer(row["vectors"], f"<i{len(row['vectors']) // (n * dims)}").reshape(n, dims)
        self.reach = float(np.sqrt((self.exact.astype(float) ** 2).sum(axis=1).max()))
        self.ids = np.frombuffer(row["ids"], "<i8")
        owner = np.frombuffer(row["owner"], "<i4")
        self.begin = np.searchsorted(owner, np.arange(n + 1))
        self.width = np.frombuffer(row["width"], "<i8").astype(float)
        self.error = row.get("error", np.inf)
        cells = np.frombuffer(row["cells"], np.uint8).reshape(n, dims).astype(float)
        middle = np.rint(cells.mean(axis=0))
        cells -= middle
        self.base = np.frombuffer(row["low"], "<i8") + middle * self.width + (self.width - 1) / 2
        self.spread = max(float(np.sqrt((cells**2).sum(axis=1).max())), 1.0)
        self.products = None
        if LEVEL / self.spread > 2 * np.sqrt(dims):
            part = -(-n // FIELDS)
            self.products = np.zeros((dims + 2, part))
            for i in range(FIELDS):
                own = cells[i * part : (i + 1) * part].T
                self.products[:dims, : own.shape[1]] += own * float(1 << BITS * i)
            self.products[dims:] = [[_EACH], [2.0**52]]  # a sum from 2**52 has its fields in the lowest bits
        self._typed: dict = {}

    def typed(self, kind: type) -> np.ndarray:
        if kind not in self._typed:
            self._typed[kind] = self.exact.astype(kind)
        return self._typed[kind]


class _Block:
    """Queries with the best k so far of each, in order of score and id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        self.scores, self.found = np.full((len(ids), k), _NONE), np.full((len(ids), k), _LAST)
        self.wait = self.waited = 0

    def merge(self, pack: _Pack, q: np.ndarray, at: np.ndarray, scores: np.ndarray) -> None:
        """Take in the exact scores of vectors ``at`` of a pack, of each vector and query once."""
        smallest = pack.ids[pack.begin[at]]
        good = (scores > self.scores[q, -1]) | ((scores == self.scores[q, -1]) & (smallest < self.found[q, -1]))
        q, at, scores = q[good], at[good], scores[good]
        if not len(q):
            return
        held = pack.begin[at + 1] - pack.begin[at]
        ids = pack.ids[np.arange(held.sum()) + np.repeat(pack.begin[at] - (np.cumsum(held) - held), held)]
        q, scores = np.repeat(q, held), np.repeat(scores, held)
        other = ids != self.ids[q]
        rows = np.unique(q)
        q = np.concatenate([np.repeat(rows, self.k), q[other]])
        scores, ids = np.concatenate([self.scores[rows].ravel(), scores[other]]), np.concatenate([self.found[rows].ravel(), ids[other]])
        order = np.lexsort((ids, ~scores, q))  # ~x falls as x rises, and has no overflow
        q, scores, ids = q[order], scores[order], ids[order]
        best = (np.searchsorted(q, rows)[:, None] + np.arange(self.k)).ravel()
        self.scores[rows], self.found[rows] = scores[best].reshape(-1, self.k), ids[best].reshape(-1, self.k)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the queries, ids, scores."""
        q, place = np.nonzero(self.scores != _NONE)
        return q, self.found[q, place], self.scores[q, place]

    def scan(self, pack: _Pack) -> int:
        """Take in the best k of a pack; returns how many exact vectors were read."""
        most = float(self.norms.max(initial=0)) * pack.reach  # bounds every partial sum of a product
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
        queries = self.vectors.astype(kind)
        read, rows, before = 0, np.arange(len(queries)), self.scores[:, -1].copy()
        if self.wait:
            self.wait -= 1
        elif pack.products is not None:
            read, rows, before = self._by_bounds(pack, queries, kind)
        for a in range(0, len(rows), ROWS):
            read += self._whole(pack, queries, kind, rows[a : a + ROWS], before[a : a + ROWS])
        return read

    def _by_bounds(self, pack: _Pack, queries: np.ndarray, kind: type) -> tuple[int, np.ndarray, np.ndarray]:
        """Exact scores of the vectors whose bound reaches the k-th best score. Returns how many vectors were read, the queries that need
        most of the pack, and their k-th best scores so far."""
        n, part = pack.n, pack.products.shape[1]
        vectors = self.vectors.astype(float)
        weights = vectors * pack.width
        steps = (LEVEL / pack.spread - np.sqrt(weights.shape[1]) / 2) / np.maximum(np.sqrt(np.einsum("ij,ij->i", weights, weights)), 1e-9)
        weights *= steps[:, None]
        left = np.ones((len(vectors), weights.shape[1] + 2))
        weights -= np.rint(weights, out=left[:, :-2])
        hidden = np.sqrt(np.einsum("ij,ij->i", weights, weights)) / steps * pack.spread  # by rounding, then by cells
        hidden += self.norms * pack.error if np.isfinite(pack.error) else np.abs(vectors) @ ((pack.width - 1) / 2)
        base = vectors @ pack.base

        def fields(rows: np.ndarray, limit: np.ndarray) -> np.ndarray:
            left[rows, -2] = (1 << BITS - 1) - limit
            return (left[rows] @ pack.products).view(np.int64)

        fresh, few, first = np.flatnonzero(self.scores[:, -1] == _NONE), min(CHUNK, n), []
        kept = self.scores[fresh], self.found[fresh]
        for a in range(0, len(fresh), ROWS):
            rows = fresh[a : a + ROWS]
            sums = fields(rows, np.zeros(len(rows)))
            bounds = np.concatenate([sums >> BITS * i & (1 << BITS) - 1 for i in range(FIELDS)], axis=1)[:, :n]
            q, at = np.repeat(rows, few), np.argpartition(bounds, n - few, axis=1)[:, n - few :].ravel()
            self._exact(pack, queries, kind, q, at)
            first.append(q * n + at)
        kth = self.scores[:, -1].astype(float)
        slack = 1e-9 * (np.abs(kth) + np.abs(base) + hidden + self.norms * pack.reach + 1)
        limit = np.minimum(np.floor((kth - base - hidden - slack) * steps), LEVEL)
        many = limit < 0
        parts, rest = [(np.zeros(0, np.int64), np.zeros((0, part), np.int64))], np.flatnonzero(~many)
        for a in range(0, len(rest), ROWS):
            rows = rest[a : a + ROWS]
            sums = fields(rows, limit[rows])
            reached = np.flatnonzero(np.bitwise_or.reduce(sums, axis=1) & _REACHED)
            rows, sums = rows[reached], sums[reached] & _REACHED
            full = np.count_nonzero(sums, axis=1) > n / MANY
            many[rows[full]] = True
            parts.append((rows[~full], sums[~full]))
        some, sums = (np.concatenate(x) for x in zip(*parts, strict=True))
        hits = np.flatnonzero(sums)
        word, field = np.nonzero(sums.ravel()[hits, None] >> (np.arange(FIELDS) * BITS + BITS - 1) & 1)
        q, at = some[hits[word] // part], hits[word] % part + field * part
        q, at = q[at < n], at[at < n]
        if first:
            new = ~np.isin(q * n + at, np.concatenate(first))
            q, at = q[new], at[new]
        self._exact(pack, queries, kind, q, at)
        rows = np.flatnonzero(many)
        before = self.scores[rows, -1]
        again = many[fresh]  # these meet their first vectors once more
        self.scores[fresh[again]], self.found[fresh[again]] = kept[0][again], kept[1][again]
        self.wait = self.waited = min(WAIT, 2 * self.waited + 1) if 2 * len(rows) > len(many) else 0
        return len(q) + len(fresh) * few, rows, before

    def _exact(self, pack: _Pack, queries: np.ndarray, kind: type, q: np.ndarray, at: np.ndarray) -> None:
        vectors, step = pack.typed(kind), max(1, (1 << 22) // queries.shape[1])
        for a in range(0, len(q), step):
            x, y = q[a : a + step], at[a : a + step]
            self.merge(pack, x, y, np.einsum("ij,ij->i", queries[x], vectors[y]).astype(np.int64))

    def _whole(self, pack: _Pack, queries: np.ndarray, kind: type, rows: np.ndarray, before: np.ndarray) -> int:
        """Exact scores of the whole pack; ``before`` are scores that k of the vectors met so far reach, or none."""
        scores = queries[rows] @ pack.typed(kind).T
        largest = {np.float32: 2**24, np.float64: 2**53}.get(kind, _LAST)
        least = np.clip(before, -largest, largest).astype(kind)  # all scores lie between
        none = np.flatnonzero(before == _NONE)
        if pack.n > self.k + 1 and len(none):  # enough unless the query's own id has several vectors here
            least[none] = np.partition(scores[none], pack.n - self.k - 1, axis=1)[:, pack.n - self.k - 1]
        kept = self.scores[rows], self.found[rows]
        hits = np.flatnonzero(scores >= least[:, None])
        self.merge(pack, rows[hits // pack.n], hits % pack.n, scores.ravel()[hits].astype(np.int64))
        for i in none[self.scores[rows[none], -1] == _NONE].tolist():
            self.scores[rows[i]], self.found[rows[i]] = kept[0][i], kept[1][i]
            self.merge(pack, np.full(pack.n, rows[i]), np.arange(pack.n), scores[i].astype(np.int64))
        return scores.size


def search_pack(query_ids: np.ndarray, queries: np.ndarray, pack: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best k of one pack for every query: positions of the queries, ids, scores; and how many exact vectors were read."""
    block = _Block(query_ids, queries, k)
    read = block.scan(_Pack(pack))
    return *block.best(), read


def _query_rows(packs: DataFrame) -> DataFrame:
    """(id, dims, v) of the rows that are queries; v holds 64-bit integers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, size = np.frombuffer(row["asked_ids"], "<i8"), 8 * row["dims"]
                v = [row["asked_vectors"][a : a + size] for a in range(0, len(row["asked_vectors"]), size)]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([row["dims"]] * len(ids), pa.int32()), pa.array(v, pa.binary())], names=["id", "dims", "v"])

    return packs.where("asked > 0").select("dims", "asked_ids", "asked_vectors").mapInArrow(rows, "id long, dims int, v binary")


def _query_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """(block, dims, ids, vectors) with the different query rows, dealt to so many blocks."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                inner = batch.slice(i, 1).column("queries").flatten()
                v = np.frombuffer(b"".join(inner.field("v").to_pylist()), "<i8")
                parts = (inner.field("id").to_numpy(zero_copy_only=False).astype("<i8"), _narrow(v))
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), batch.column("dims").slice(i, 1), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["block", "dims", "ids", "vectors"])

    dealt = rows.dropDuplicates(["id", "v"]).withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block", "dims").agg(F.collect_list(F.struct("id", "v")).alias("queries")).mapInArrow(join, "block int, dims int, ids binary, vectors binary")


def top_k(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256, pack: int = PACK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, id and score of the k highest inner products of every query (a condition on the column ``id``) among all other rows.

    Vectors whose products could leave 64 bits are an error.
    """
    spark = rows.sparkSession
    narrow = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("raw")).where("id is not null and raw is not null")
    packs = written(_packs(narrow.withColumn("asked", F.coalesce(is_query, F.lit(False))), pack, k, scale), "vector-packs")
    whole = packs.agg(F.max("dims"), F.max("most"), F.sum("asked"), F.count("*")).first()
    if whole[0] and whole[0] * whole[1] ** 2 >= 2.0**63:
        raise ValueError("components are too large: sums of their products do not fit 64 bits")
    blocks = max(1, -(-(whole[2] or 0) // query_block))
    groups = max(-(-blocks // GROUP), min(blocks, GROUPS))
    deal = -(-blocks // groups)  # blocks in a group
    shards = max(1, min(whole[3], max(-(-whole[3] * deal // WORK), -(-2 * spark.sparkContext.defaultParallelism // groups))))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = _query_blocks(_query_rows(packs), blocks).withColumn("shard", each(shards)).withColumn("task", (F.floor(F.col("block") / deal) * shards + F.col("shard")).cast("int"))
    dealt = packs.withColumn("group", each(groups)).withColumn("task", (F.col("group") * shards + F.pmod(F.xxhash64("pack"), F.lit(shards))).cast("int"))
    parts = ["cells", "low", "width", "owner"]
    queries = queries.select("task", "dims", F.lit(0).alias("kind"), "ids", "vectors", *(F.lit(None).cast("binary").alias(c) for c in parts), F.lit(None).cast("double").alias("error"))
    both = queries.unionByName(dealt.select("task", "dims", F.lit(1).alias("kind"), "ids", "vectors", *parts, "error"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = 0, []

        def found() -> Iterator[pa.RecordBatch]:
            for block in held:
                q, ids, scores = block.best()
                yield pa.RecordBatch.from_arrays([pa.array(block.ids[q]), pa.array(ids), pa.array(scores)], names=["query_id", "id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                dims, kind = batch.column("dims")[i].as_py(), batch.column("kind")[i].as_py()
                if dims != at:
                    yield from found()
                    at, held = dims, []
                if kind and not held:
                    continue
                row = {c: batch.column(c)[i].as_py() for c in ("dims", "ids", "vectors", *parts, "error")}
                if kind:
                    one = _Pack(row)
                    for block in held:
                        block.scan(one)
                else:
                    ids = np.frombuffer(row["ids"], "<i8")
                    v = np.frombuffer(row["vectors"], f"<i{len(row['vectors']) // (len(ids) * dims)}")
                    held.append(_Block(ids, v.reshape(-1, dims), k))
        yield from found()

    tasks = both.repartitionById(groups * shards, "task").sortWithinPartitions("dims", "kind")  # a partition for each task
    best = tasks.drop("task").mapInArrow(search, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
