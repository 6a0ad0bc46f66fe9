"""Near duplicates of texts by ProbMinHash signatures, banding, and exact verification.

A text is the weighted set of its shingles: ``SHINGLE`` consecutive words (runs outside space and 0x09-0x0D, lower case), weighted by how often they occur. Texts
of fewer words have one shingle of all their words. The similarity is the probability Jaccard similarity, which is the plain Jaccard
similarity where all weights are equal.

Signature: every shingle sends arrivals of a Poisson process with its weight as rate to random registers, all derived from its hash; each
register keeps the shingle that arrived first. A shingle stops once its next arrival is behind all registers of its text. Two texts agree in
a register with a probability equal to their similarity.

Candidates: ``BANDS`` bands of ``ROWS`` registers. At similarity 0.8 a pair shares no band with probability (1 - 0.8**5)**32 = 3e-6, and
less above. Within a bucket pairs are not enumerated: all members are held against a pivot, verified exactly, joined into
classes, and the buckets that still hold several classes go into further rounds, in which a block of pivots is held against all
others by an inverted index of its shingles, until no pair of different classes is left unseen. A bucket of one group of copies, however many, is done after its first round.

Defined results: a null text, and a text without words, is a class of its own per row id and never a copy. Copies with equal lower-case
texts are one node from the start. Null ids sort last; a class of null ids only has the class id null. Repeated rows come back repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F, types as T

from changeflow.llm.common import SLICE_BYTES, find_words, gram_hashes, mix64, slices, span_hashes, text_bytes, written

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 5
PIVOTS = 512  # members of a bucket held against all its others in one later round
HITS = 1 << 20  # common shingles of a text and the pivots looked at together
PART = 4096  # members of a bucket that one task compares with its pivots
_U = np.uint64
_STEP, _REGISTER, _BAND = _U(0xD1B54A32D192ED03), _U(0x8CB92BA72F3D8DD7), _U(0xA24BAED4963EE407)
_HASH_BITS = _U(44)  # of a shingle, within one slice


def weighted_shingles(raw: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and number of occurrences of the distinct shingles of every text, in order of row and hash."""
    n = len(offsets) - 1
    s, e, rows = find_words(raw, offsets)
    words = span_hashes(raw, s, e)
    grams, at = gram_hashes(words, rows, k)
    owner = rows[at]
    count = np.bincount(rows, minlength=n)
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        first = np.searchsorted(rows, few)
        whole = [_fold(words[a : a + c]) for a, c in zip(first, count[few], strict=True)]
        grams, owner = np.concatenate([grams, np.array(whole, _U)]), np.concatenate([owner, few])
    key = (owner.astype(_U) << _HASH_BITS) | (grams >> (_U(64) - _HASH_BITS))
    key.sort()
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0, np.int64)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return (key[edge] >> _HASH_BITS).astype(np.int64), key[edge] & ((_U(1) << _HASH_BITS) - _U(1)), np.diff(np.append(edge, len(key)))


def _fold(words: np.ndarray) -> int:
    h = np.full(1, len(words), _U)
    for w in words:
        h = mix64(h * _STEP + w)
    return int(h[0])


def prob_minhash(rows: np.ndarray, ids: np.ndarray, weights: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n x m): in every register the id of the first arrival; zeros for a row without elements."""
    time, kept = np.full(n * m, np.inf), np.zeros(n * m, _U)
    start, seed, at, rate = np.zeros(len(ids)), mix64(ids + _STEP), rows, weights.astype(float)
    own, number = ids, 0
    while len(own):
        number += 1
        draw = mix64(seed + _U(number * int(_STEP) % (1 << 64)))
        start = start - np.log1p(-(draw >> _U(11)).astype(float) * 2.0**-53) / rate
        if number > 1:
            live = start < time.reshape(n, m).max(axis=1)[at]
            start, seed, at, rate, own, draw = start[live], seed[live], at[live], rate[live], own[live], draw[live]
        slot = at * m + ((mix64(draw ^ _REGISTER) >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)
        np.minimum.at(time, slot, start)
        won = time[slot] == start
        kept[slot[won]] = own[won]
    return kept.reshape(n, m)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    parts = signature.reshape(len(signature), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=_U) * _BAND, (len(signature), bands)).copy()
    for j in range(rows):
        h = mix64(h * _STEP + parts[:, :, j])
    return h


def probability_jaccard(a_ids: np.ndarray, a_weights: np.ndarray, b_ids: np.ndarray, b_weights: np.ndarray) -> float:
    """The probability Jaccard similarity of two weighted sets (ids sorted, distinct).

    Sum over common d of 1 / sum over d' of max(a(d') / a(d), b(d') / b(d)): with t = b / a, the inner sum is, up to 1 / a(d),
    the weights a of all d' with t(d') <= t(d) and b / t(d) of the others, which sorted t gives as running sums.
    """
    if not len(a_ids) or not len(b_ids):
        return 0.0
    ids = np.union1d(a_ids, b_ids)
    a, b = np.zeros(len(ids)), np.zeros(len(ids))
    a[np.searchsorted(ids, a_ids)], b[np.searchsorted(ids, b_ids)] = a_weights, b_weights
    with np.errstate(divide="ignore"):
        t = np.where(a > 0, b / np.where(a > 0, a, 1), np.inf)
    order = np.argsort(t, kind="stable")
    t, a, b = t[order], a[order], b[order]
    sum_a, rest_b = np.cumsum(a), np.cumsum(b[::-1])[::-1]
    both = np.flatnonzero((a > 0) & (b > 0))
    last = np.searchsorted(t, t[both], "right")
    rest = np.where(last < len(t), rest_b[np.minimum(last, len(t) - 1)], 0.0)
    return float((a[both] / (sum_a[last - 1] + rest / t[both])).sum())


def signatures(texts: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, text) to (node, bands array<long>, packed binary): band keys, and the text compressed for the verification; rows without words are left out."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, limit=SLICE_BYTES // 4):
            raw, offsets = text_bytes(batch.column("text"))
            owner, ids, weights = weighted_shingles(raw, offsets, shingle)
            keys = band_keys(prob_minhash(owner, ids, weights, batch.num_rows, bands * rows), bands, rows).view(np.int64)
            some = np.unique(owner)
            packed = [press.compress(raw[offsets[i] : offsets[i + 1]].tobytes()) for i in some]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * bands, pa.int32()), pa.array(keys[some].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(some)), lists, pa.array(packed, pa.binary())], names=["node", "bands", "packed"])

    return texts.mapInArrow(sign, "node long, bands array<long>, packed binary")


def unpacked_slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES // 4) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts take about ``limit`` bytes when unpacked: a text of one repeated line packs to a hundredth. A longer text comes alone."""
    for batch in batches:
        start, held = 0, 0
        for i, packed in enumerate(batch.column("packed")):
            size = zstandard.frame_content_size(packed.as_buffer())
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def _similar(pairs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b, packed_a, packed_b) to the pairs (a, b) whose similarity is high enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        known: tuple[int | None, tuple] = (None, ())

        def shingles(packed: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
            raw = np.frombuffer(unpack.decompress(packed.as_buffer()), np.uint8)
            return weighted_shingles(raw, np.array([0, len(raw)]), shingle)[1:]

        for batch in batches:
            keep = []
            a, pa_, pb = batch.column("a").to_pylist(), batch.column("packed_a"), batch.column("packed_b")
            for i in range(batch.num_rows):
                if known[0] != a[i]:
                    known = (a[i], shingles(pa_[i]))
                keep.append(probability_jaccard(*known[1], *shingles(pb[i])) >= similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(verify, "a long, b long")


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, class): the smallest node that undirected links lead to, for every node with a link.

    Rounds of smallest neighbours with pointer jumping; each round is a written table, and their number grows with the logarithm of the longest chain.
    """
    both = links.select(F.col(left).alias("u"), F.col(right).alias("v"))
    both = written(both.unionByName(links.select(F.col(right).alias("u"), F.col(left).alias("v"))).distinct(), "near-links")
    label = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("class")).withColumnRenamed("u", "node")
    label = written(label, "near-class")
    while True:
        near = both.join(label, both["v"] == label["node"]).groupBy("u").agg(F.min("class").alias("seen"))
        step = label.join(near, label["node"] == near["u"], "left").select("node", "class", F.least("class", "seen").alias("next"))
        jump = label.select(F.col("node").alias("next"), F.col("class").alias("beyond"))
        step = written(step.join(jump, "next", "left").select("node", F.col("class").alias("old"), F.least("next", "beyond").alias("class")), "near-class")
        label = step.select("node", "class")
        if step.where(F.col("old") != F.col("class")).isEmpty():
            return label


def text_node(text):
    """The node of a text: 64 bits of its lower-case form (among 10**9 texts, two different ones share a node in one corpus of some 40); null without words."""
    text = F.lower(text)
    return F.when(text.rlike(r"[^ \t\n\x0B\f\r]"), F.xxhash64(text))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: id, class_id (the smallest id of its class), class_size (rows), and node (the hash of its lower-case text).

    A class holds everything that links of texts of ``similarity`` or more lead to.
    """
    own = docs.select(F.col(id_col).alias("id"), text_node(F.col(text_col)).alias("node"))
    label = linked_nodes(docs.select(F.col(text_col).alias("text")), shingle, similarity, bands, rows)
    marked = own.join(label, "node", "left").withColumn("class", F.coalesce("class", "node"))
    summary = marked.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("first_id"), F.count("*").alias("members"))
    out = marked.join(summary, "class", "left")
    alone = F.col("class").isNull()  # no words: its own class
    return out.select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("first_id")).alias("class_id"), F.coalesce("members", F.lit(1)).alias("class_size"), "node")


def linked_nodes(texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(node, class) of all nodes of ``text`` that have a near duplicate."""
    nodes = texts.select(text_node(F.col("text")).alias("node"), F.lower("text").alias("text")).where(F.col("node").isNotNull())
    # one row per node; copies met in the same task are merged before the shuffle
    signed = written(signatures(nodes, shingle, bands, rows).groupBy("node").agg(F.first("bands").alias("bands"), F.first("packed").alias("packed")), "near-signatures")
    return _classes(signed, shingle, similarity)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of each class: of the smallest id (null last), and among several of that id the one of the smallest hash of text and of all columns.

    A text without words is a class of its own per row id; with a null id each such row is kept.
    """
    columns, names = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    own, text = F.col(names[columns.index(id_col)]), F.col(names[columns.index(text_col)])
    tie = F.xxhash64(*[F.col(n) for n, f in zip(names, docs.schema, strict=True) if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    # keys without nulls, so that the join and the grouping share one shuffle
    key = {"__id": F.coalesce(own.cast("string"), F.lit("")), "__none": own.isNull(), "__node": F.coalesce(text_node(text), F.lit(0)), "__tie": tie}
    rows = rows.withColumns(key | {"__words": text_node(text).isNotNull()})
    worded = rows.where("__words")
    label = linked_nodes(docs.select(F.col(text_col).alias("text")), **settings)
    narrow = worded.select(own.alias("__own"), *key).join(label.withColumnRenamed("node", "__node"), "__node", "left")
    order = F.struct("__none", "__own", "__node", "__tie", "__id")
    first = narrow.groupBy(F.coalesce("class", "__node")).agg(F.min(order).alias("o")).select(*(F.col(f"o.{c}").alias(c) for c in key))
    kept = worded.join(first, list(key)).dropDuplicates(list(key))
    bare = rows.where("not __words")
    alone = bare.where("not __none").withColumn("__n", F.row_number().over(Window.partitionBy("__id").orderBy("__tie"))).where("__n = 1")
    return kept.select(*names).unionByName(alone.select(*names)).unionByName(bare.where("__none").select(*names)).toDF(*columns)


def _classes(signed: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(node, class) of all nodes with a verified link.

    Round 1 holds every node against the smallest of its buckets' pivots, which settles groups of copies, and round 2 against its other pivots.
    Every further round takes PIVOTS more pivots from each bucket that still holds several classes.
    """
    entries = signed.select("node", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last").select("key", "pivot")
    members = written(entries.join(shared, "key"), "near-buckets")  # only buckets of several nodes
    packed = written(signed.select("node", "packed").join(members.select("node").distinct(), "node", "left_semi"), "near-texts")
    a, b = packed.select(F.col("node").alias("a"), F.col("packed").alias("packed_a")), packed.select(F.col("node").alias("b"), F.col("packed").alias("packed_b"))
    verified = lambda pairs: written(_similar(pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b")).join(b, "b").join(a, "a"), shingle, similarity), "near-found")

    first = written(members.where("pivot <> node").groupBy("node").agg(F.min("pivot").alias("pivot")), "near-pairs")
    label = _joined(signed.sparkSession.createDataFrame([], "node long, class long"), verified(first))
    named = _mixed(members, label)
    heads = named.where("pivot = node").select("key", F.col("class").alias("head_class"))
    pairs = named.join(heads, "key").where("pivot <> node and class <> head_class").select("node", "pivot").distinct().join(first, ["node", "pivot"], "left_anti")
    label = _joined(label, verified(pairs))
    members = named.where("node <> pivot").select("key", "node")
    while True:
        named = _mixed(members, label)
        if named.isEmpty():
            return label
        rank = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        chosen = written(named.withColumn("rank", rank).where(F.col("rank") <= PIVOTS).drop("rank"), "near-pivots")
        label = _joined(label, written(_block_links(named, chosen, packed, shingle, similarity), "near-found"))
        members = named.join(chosen.groupBy("key").agg(F.max("node").alias("last")), "key").where("node > last").select("key", "node")


def _mixed(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes, with their class."""
    named = members.join(label, "node", "left").withColumn("class", F.coalesce("class", "node"))
    mixed = named.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key")
    return written(named.join(mixed, "key", "left_semi"), "near-buckets")


def _block_links(named: DataFrame, chosen: DataFrame, packed: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Verified links between the chosen pivots of each bucket and its larger members of other classes.

    A bucket is dealt out in parts of about PART members, each with a copy of the pivots; a task holds the pivots of one part at a time.
    """
    parts = named.groupBy("key").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    heads = chosen.join(parts, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), "node", "class")
    rest = named.join(parts, "key").select("key", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "node", "class")
    rows = heads.unionByName(rest).join(packed, "node").select("key", "part", "role", "node", "class", "packed")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        current, block = None, _Block(similarity)
        for batch in unpacked_slices(batches):
            texts = [unpack.decompress(p) for p in batch.column("packed").to_pylist()]
            raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            owner, ids, weights = weighted_shingles(raw, offsets, shingle)
            at = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            out: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("key", "part", "role", "node", "class")]
            for i, (key, part, role, node, group) in enumerate(zip(*columns, strict=True)):
                if current != (key, part):
                    current, block = (key, part), _Block(similarity)
                own = ids[at[i] : at[i + 1]], weights[at[i] : at[i + 1]]
                if role == 0:
                    block.add(node, group, *own)
                else:
                    out += [(p, node) for p in block.links(node, group, *own)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return rows.repartition("key", "part").sortWithinPartitions("key", "part", "role", "node").mapInArrow(compare, "a long, b long").distinct()


class _Block:
    """Pivots with an inverted index of their shingles."""

    def __init__(self, similarity: float):
        self.similarity, self.pivots, self.index = similarity, [], None

    def add(self, node: int, group: int, ids: np.ndarray, weights: np.ndarray) -> None:
        self.pivots.append((node, group, ids, weights))

    def links(self, node: int, group: int, ids: np.ndarray, weights: np.ndarray) -> list[int]:
        """Pivots of smaller node and another class that are similar enough.

        Only pivots whose upper bound is high enough are computed. With p and q as the shares of a common shingle in the two texts and M the sum
        of their minima, its part of the similarity is at most min(p, q), and at most max(p, q) / (2 - M), since the sum of the maxima is 2 - M.
        """
        if not self.pivots:
            return []
        if self.index is None:
            every = np.concatenate([p[2] for p in self.pivots])
            owner = np.repeat(np.arange(len(self.pivots)), [len(p[2]) for p in self.pivots])
            order = np.argsort(every, kind="stable")
            mass = np.concatenate([p[3] / p[3].sum() for p in self.pivots])
            self.index = every[order], owner[order], mass[order]
            self.nodes, self.groups = np.array([p[0] for p in self.pivots]), np.array([p[1] for p in self.pivots])
        every, owner, mass = self.index
        low, high = np.searchsorted(every, ids, "left"), np.searchsorted(every, ids, "right")
        times = high - low
        n, share, total = len(self.pivots), weights / weights.sum(), np.cumsum(times)

        def common(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Pivot, smaller and larger share of the shingles a to b that pivots have too."""
            some = times[a:b]
            hit = np.repeat(low[a:b], some) + np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some)
            here, there = np.repeat(share[a:b], some), mass[hit]
            return owner[hit], np.minimum(here, there), np.maximum(here, there)

        edges = [0, *(np.flatnonzero(np.diff(total // HITS)) + 1).tolist(), len(ids)]
        spans = list(zip(edges, edges[1:], strict=False))
        whole = common(*spans[0]) if len(spans) == 1 else None
        both, bound = np.zeros(n), np.zeros(n)
        for span in spans:
            at, less, _ = whole or common(*span)
            both += np.bincount(at, less, n)
        for span in spans:
            at, less, more = whole or common(*span)
            bound += np.bincount(at, np.minimum(more / (2 - both)[at], less), n)
        maybe = np.flatnonzero((bound >= self.similarity - 1e-9) & (self.nodes < node) & (self.groups != group))
        return [self.pivots[k][0] for k in maybe if probability_jaccard(*self.pivots[k][2:], ids, weights) >= self.similarity]


def _joined(label: DataFrame, found: DataFrame) -> DataFrame:
    """Classes after new links: the links between classes are few, and only they are followed."""
    if found.isEmpty():
        return label
    known = label.unionByName(found.select(F.col("a").alias("node"), F.col("a").alias("class"))).unionByName(found.select(F.col("b").alias("node"), F.col("b").alias("class")))
    known = written(known.groupBy("node").agg(F.min("class").alias("class")), "near-class")
    left, right = known.select(F.col("node").alias("a"), F.col("class").alias("u")), known.select(F.col("node").alias("b"), F.col("class").alias("v"))
    links = found.join(left, "a").join(right, "b").where("u <> v").select("u", "v").distinct()
    merged = components(links, "u", "v").select(F.col("node").alias("class"), F.col("class").alias("into"))
    return written(known.join(merged, "class", "left").select("node", F.coalesce("into", "class").alias("class")), "near-class")
