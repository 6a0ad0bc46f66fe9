"""Token ids as bit- or byte-plane shuffled, zstandard-compressed blocks with a chunk index.

A set of files is a Parquet folder with one row per block, in shards. A shard holds the ids of a range of documents in ascending id order.
A block holds up to ``block_ids`` ids, cut regardless of document edges: a header of ``HEADER``, one length per plane, and the planes, each
one zstandard frame. Plane k of a byte-plane block holds byte k of every id, of a bit-plane block bit k. Planes of zeros only are left out (length 0).
The row beside the payload is the chunk index: shard, block number, the first id's place in the shard, the number of ids, and the
documents that end in the block with their lengths. Nothing of a file is held in memory but one block.

Null texts are empty texts; both get the end id alone. Rows with equal ids stand one after another in the order of their texts; null ids
come first. Empty tables give an empty folder that reads as no rows. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from changeflow.llm.common import slices
from changeflow.llm.segments import encoder
from changeflow.scratch import shared_path

MAGIC = b"TPB1"
HEADER = struct.Struct("<4sBBHI")  # magic, 1 = bits or 8 = bytes, planes, unused, ids
SHARD_BYTES = 64 << 20  # text per shard, about
_LOWEST = -(1 << 63)


def pack_block(ids: np.ndarray, planes: str = "bytes", level: int = 3) -> bytes:
    """One block of unsigned 32-bit ids as bytes."""
    ids = np.ascontiguousarray(ids, "<u4")
    if planes == "bits":
        rows = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little").T
        rows = [np.packbits(r, bitorder="little").tobytes() for r in rows]
    elif planes == "bytes":
        rows = [r.tobytes() for r in np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4).T)]
    else:
        raise ValueError("planes: bits or bytes")
    press = zstandard.ZstdCompressor(level=level)
    frames = [press.compress(r) if any(r) else b"" for r in rows]
    return b"".join([HEADER.pack(MAGIC, 1 if planes == "bits" else 8, len(frames), 0, len(ids)), struct.pack(f"<{len(frames)}I", *map(len, frames)), *frames])


def unpack_block(block: bytes) -> np.ndarray:
    """The ids of a block."""
    magic, width, planes, _, n = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of token planes")
    sizes = struct.unpack_from(f"<{planes}I", block, HEADER.size)
    at, press = HEADER.size + 4 * planes, zstandard.ZstdDecompressor()
    plane_bytes = n if width == 8 else (n + 7) // 8
    rows = np.zeros((planes, plane_bytes), np.uint8)
    for k, size in enumerate(sizes):
        if size:
            rows[k] = np.frombuffer(press.decompress(block[at : at + size], max_output_size=plane_bytes), np.uint8)
        at += size
    if width == 8:
        return np.ascontiguousarray(rows.T).view("<u4").reshape(n)
    bits = np.unpackbits(rows, axis=1, bitorder="little", count=n)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").reshape(n)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", block_ids: int = 1 << 16, planes: str = "bytes", shards: int | None = None) -> None:
    """Encode whole texts, add ``end_id`` to each, and write the ids in ascending id order to ``path``.

    One range shuffle by id; each partition is one shard, encoded and compressed as a stream.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = narrow.repartitionByRange(n, "id").sortWithinPartitions("id", "text")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], enc.kind).tobytes()
        size, number, first = enc.kind.itemsize, 0, 0
        waiting, held = [], 0  # ids not yet written, as bytes
        ends: list[tuple[int | None, int, int]] = []  # (document, ids, place behind its last id) not yet written
        place = 0

        def cut(count: int) -> pa.RecordBatch:
            nonlocal waiting, held, number, first, ends
            raw = b"".join(waiting)
            ids, rest = np.frombuffer(raw, enc.kind, count), raw[count * size :]
            done = [e for e in ends if e[2] <= first + count]
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()), pa.array([count], pa.int32()),
                    pa.array([[d for d, _, _ in done]], pa.list_(pa.int64())), pa.array([[k for _, k, _ in done]], pa.list_(pa.int64())),
                    pa.array([pack_block(ids, planes)], pa.binary()),
                ],
                names=["shard", "block", "first_id", "n_ids", "doc_ids", "doc_lengths", "payload"],
            )
            ends = ends[len(done) :]
            waiting, held, number, first = [rest] if rest else [], held - count, number + 1, first + count
            return row

        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("id").to_pylist(), enc.encode(texts), strict=True):
                waiting += [ids, end]
                k = len(ids) // size + 1
                held, place = held + k, place + k
                ends.append((doc, k, place))
                while held >= block_ids:
                    yield cut(block_ids)
        if held:
            yield cut(held)

    schema = "shard int, block int, first_id long, n_ids int, doc_ids array<long>, doc_lengths array<long>, payload binary"
    ordered.mapInArrow(blocks, schema).write.option("compression", "uncompressed").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and shard.

    Blocks are read in order of (shard, block), one shard per task; a document that spans blocks is checked as a stream. The starts of
    shards come from the chunk index alone.
    """
    blocks = spark.read.schema("shard int, block int, first_id long, n_ids int, doc_ids array<long>, doc_lengths array<long>, payload binary").parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    starts = sizes.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("shard_start"))  # one row per shard
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = blocks.repartition(tasks, "shard").sortWithinPartitions("shard", "block")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, crc, open_ids = None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if open_ids:
                        raise ValueError(f"shard {shard} ends inside a document")
                    shard, crc, place = row["shard"], 0, 0
                ids = unpack_block(row["payload"])
                if row["first_id"] != place or len(ids) != row["n_ids"]:
                    raise ValueError(f"shard {shard}, block {row['block']}: chunk index and ids differ")
                raw, at, out = memoryview(ids.tobytes()), 0, []
                for doc, length in zip(row["doc_ids"], row["doc_lengths"], strict=True):
                    take = length - open_ids
                    crc = zlib.crc32(raw[4 * at : 4 * (at + take)], crc)
                    at += take
                    out.append((shard, doc, place + at - length, length, crc))
                    crc, open_ids = 0, 0
                crc = zlib.crc32(raw[4 * at :], crc)
                open_ids += len(ids) - at
                place += len(ids)
                if out:
                    cols = list(zip(*out, strict=True))
                    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["shard", "doc_id", "place", "n_tokens", "ids_crc32"])

    docs = ordered.mapInArrow(check, "shard int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return docs.join(starts, "shard").select("doc_id", (F.col("place") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32", "shard")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id and its ids as array<long>, from the files."""
    blocks = spark.read.schema("shard int, block int, first_id long, n_ids int, doc_ids array<long>, doc_lengths array<long>, payload binary").parquet(path)
    ordered = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").sortWithinPartitions("shard", "block")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = unpack_block(row["payload"]), 0
                for doc, length in zip(row["doc_ids"], row["doc_lengths"], strict=True):
                    take = length - sum(map(len, rest))
                    whole = np.concatenate([*rest, ids[at : at + take]])
                    at, rest = at + take, []
                    yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([whole.astype(np.int64)], pa.list_(pa.int64()))], names=["doc_id", "ids"])
                if at < len(ids):
                    rest.append(ids[at:])

    return ordered.mapInArrow(split, "doc_id long, ids array<long>")


def new_path(spark: SparkSession) -> str:
    return shared_path(spark, "token-files")
