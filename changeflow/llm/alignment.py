"""Cross-tokenizer alignment of a byte-level tokenizer (A, tokenizers) with a piece tokenizer (B, sentencepiece), by token spans.

Both read a space and the text; B adds the space itself. Spans: A's character offsets and B's proto spans are the ends of all tokens that hold whole
characters; within characters of several bytes, and for byte-fallback tokens, the ends follow from the tokens' decoded bytes. Places where both have an
end cut the tokens into groups; a link is a pair of an A and a B token whose bytes overlap.

A text is cut where neither tokenizer can have a token across, so that both have an end there: before a space or line end that follows a character which is
no white space, after such a line end before a character that is none, and between an ASCII letter and a full stop or comma (A's pattern always splits there; B's pieces are checked, and it writes
line ends as bytes). Each distinct segment is encoded and aligned once per worker; words with their marks and line ends are put together from segments, and a
document from words.
Where a vocabulary allows no such cuts, texts are encoded whole.

The count of an id pair is the number of documents of the whole table that hold it linked. Tasks gather their documents in shards; counts are summed by
pair, and each shard's distinct pairs, not each document's, look up the sums by equality and come back to the shard.

Defined results: null and empty texts, and texts that a tokenizer does not give back byte for byte (those with U+2581, which B reads as a space), have
no tokens: zeros, and an empty digest. Rows count one by one, so repeated rows and null ids each hold their pairs. An empty table gives an empty
result. Texts of any length are worked off in pieces of ``PIECE_CHARS``; one segment, a run without spaces, is encoded at once. Other columns are not read; the
result's names are fixed.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from changeflow.llm.common import slices, written
from changeflow.llm.segments import _byte_letters, cut_kind

SHARD_CHARS = 1 << 23  # of text whose documents look up their pairs together
PIECE_CHARS = 1 << 20
MEMO_SEGMENTS = 1 << 20  # aligned words and segments remembered per Python worker, some 300 MB; the memo starts anew beyond it
PAIRS = 1 << 20  # of ids numbered per worker; between shards the numbers start anew beyond it
MEMO_CHARS = 1 << 25
_CUT = re.compile(r"(?<=\S)(?= .)", re.S)
_FINE = re.compile(r"(?<=\S)(?=\n)|(?<=\S\n)(?=\S)|(?<=[A-Za-z])(?=[.,])")
_FINE_MARK = re.compile(r"[.,\n]")
_ODD_SPACE = re.compile(r"  |[^\S \n]| \n|\n | $")  # elsewhere words stand between single spaces
_ACROSS = re.compile(r"[^▁]▁|\n|[A-Za-z][.,]")  # in no piece, if texts may be cut so
_WORD = re.compile(r" [A-Za-z]+")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


@lru_cache(maxsize=2)
def aligner(byte_name: str, piece_name: str) -> "Aligner":
    """The aligner of two vocabulary files of ``public_tokenizers``, or of two paths; one per Python worker."""
    return Aligner(*(n if "/" in n else public_tokenizers.path(n) for n in (byte_name, piece_name)))


def token_ends(ends: Sequence[int], ids: Sequence[int], table: list[bytes], whole: list[bool]) -> list[int]:
    """Byte end of every token: its span's end if it holds whole characters, else what its bytes add to the token before."""
    if all(map(whole.__getitem__, ids)):
        return list(ends)
    out, at = [], 0
    for i, end in zip(ids, ends, strict=True):
        at = end if whole[i] else at + len(table[i])
        out.append(at)
    return out


def overlaps(a: Sequence[int], a_ends: Sequence[int], b: Sequence[int], b_ends: Sequence[int]) -> tuple[str, int, list[int]]:
    """The groups as text, their number, and all links as ``a << 32 | b``."""
    text, links, n, i, j, i0, j0 = "", [], 0, 0, 0, 0, 0
    while i < len(a) and j < len(b):
        links.append(a[i] << 32 | b[j])
        x, y = a_ends[i], b_ends[j]
        if x < y:
            i += 1
        elif y < x:
            j += 1
        else:
            i, j, n = i + 1, j + 1, n + 1
            if i == i0 + 1 and j == j0 + 1:
                text += f";{a[i0]}|{b[j0]}"
            else:
                text += f";{','.join(map(str, a[i0:i]))}|{','.join(map(str, b[j0:j]))}"
            i0, j0 = i, j
    return text[1:], n, links


class Aligner:
    """Aligned segments by number: tokens, groups, group texts and links."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letter = {c: b for b, c in _byte_letters().items()}
        self.a_bytes = [bytes(letter.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        byte = [_BYTE_PIECE.fullmatch(p) if self.b.is_byte(i) else None for i, p in enumerate(pieces)]
        self.b_bytes = [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for p, m in zip(pieces, byte, strict=True)]
        self.a_whole = [_is_text(x) for x in self.a_bytes]
        self.b_whole = [m is None for m in byte]
        with open(byte_path, encoding="utf-8") as f:
            config = json.load(f)
        self.cuts = cut_kind(config) == "spaced" and not any(map(_ACROSS.search, pieces)) and self._keeps_spaces()
        self.pairs: dict[int, int] = {}
        self.clear()

    def new_shard(self) -> None:
        """Between shards the numbers of pairs may start anew."""
        if len(self.pairs) > PAIRS:
            self.pairs = {}
            self.clear()

    def _keeps_spaces(self) -> bool:
        """Whether B writes a text's spaces one by one, adds one before it, and writes a line end as a byte."""
        spaces = self.b.encode("a  b") == self.b.encode("a") + self.b.encode(" b")
        return spaces and [self.b_bytes[i] for i in self.b.encode("\n")] == [b" ", b"\n"]

    def clear(self) -> None:
        """Forget all segments; the numbers of pairs stay."""
        self.memo: dict[str | tuple[str], int] = {}
        self.texts: list[bytes] = []
        self.sums = array("i")  # A tokens, B tokens, groups, 1 if a token's bytes are not the text's
        self.links, self.starts, self.chars = array("i"), array("q", [0]), 0  # links by the numbers of their pairs

    def segments(self, text: str) -> list:
        """The words of a text that starts with a space: a text for a word after one space, else the segment in a tuple."""
        if not self.cuts:
            return [(text,)]
        return [(x,) for x in _CUT.split(text)] if _ODD_SPACE.search(text) else text[1:].split(" ")

    def learn(self, words: set) -> None:
        """Encode and align the words that are not known yet."""
        made, fresh = {}, set()
        for w in words.difference(self.memo):
            s = " " + w if isinstance(w, str) else w[0]
            parts = _FINE.split(s) if self.cuts and _FINE_MARK.search(s) else [s]
            if len(parts) == 1:
                fresh.add(w)
            else:
                made[w] = [p[1:] if p[0] == " " and " " not in p[1:] else (p,) for p in parts]
                fresh.update(p for p in made[w] if p not in self.memo)
        self._encode([(w, " " + w if isinstance(w, str) else w[0]) for w in fresh])
        for w, parts in made.items():
            at = [self.memo[p] for p in parts]
            if w not in self.memo:
                self.memo[w] = len(self.texts)
                self.texts.append(b";".join([self.texts[i] for i in at]))
                self.sums.extend([sum(self.sums[4 * i + k] for i in at) for k in range(4)])
                for i in at:
                    self.links.extend(self.links[self.starts[i] : self.starts[i + 1]])
                self.starts.append(len(self.links))

    def _encode(self, fresh: list[tuple]) -> None:
        # one piece of A's pattern each: its model alone tells the tokens
        plain = [x for x in fresh if self.cuts and _WORD.fullmatch(x[1])]
        others = [x for x in fresh if not (self.cuts and _WORD.fullmatch(x[1]))]
        encoded = [(e.ids, [y for _, y in e.offsets]) for e in self.a.encode_batch([s for _, s in others], add_special_tokens=False)]
        # in the model's alphabet a space has two bytes
        encoded += [([t.id for t in own], [t.offsets[1] - 1 for t in own]) for own in (self.a.model.tokenize("Ġ" + s[1:]) for _, s in plain)]
        fresh = others + plain
        # B adds a space of its own, or, before other segments, is given a line end, which stands for itself
        protos = self.b.encode([s[1:] if s[0] == " " else "\n" + s for _, s in fresh], return_type="proto", num_threads=1) if fresh else []
        for (w, s), (a, a_ends), p in zip(fresh, encoded, protos, strict=True):
            self.memo[w] = len(self.texts)
            add, drop = (1, 0) if s[0] == " " else (-1, 2)
            pieces = [(x.id, x.end + add) for x in p.pieces][drop:]
            self._add(s, a, a_ends, [i for i, _ in pieces], [y for _, y in pieces])
            self.chars += len(s)

    def _add(self, s: str, a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> None:
        raw = s.encode()
        if s == " ":  # B gives no token for an empty text
            b, b_ends = [self.b.piece_to_id("▁")], [1]
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            groups, n, links = "", 0, []
            self.sums.extend((0, 0, 0, 1))
        else:
            if len(raw) != len(s):  # A counts characters
                a_ends = [len(s[:x].encode()) for x in a_ends] if len(s) < 256 else _byte_ends(s, a_ends)
            groups, n, links = overlaps(a, token_ends(a_ends, a, self.a_bytes, self.a_whole), b, token_ends(b_ends, b, self.b_bytes, self.b_whole))
            self.sums.extend((len(a), len(b), n, 0))
        self.texts.append(groups.encode())
        number = self.pairs
        self.links.extend([number.setdefault(x, len(number)) for x in links])
        self.starts.append(len(self.links))


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def _byte_ends(text: str, ends: list[int]) -> list[int]:
    at = list(accumulate((len(c.encode()) for c in text), initial=0))
    return [at[x] for x in ends]


def _parts(text: str, size: int) -> Iterator[str]:
    """A text in parts of about ``size`` characters that end where segments end."""
    at = 0
    while at + size < len(text) and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class _Shard:
    """Documents of one task: their sums and digests, and the pairs that each holds."""

    def __init__(self, align: Aligner):
        align.new_shard()
        self.align, self.ids, self.docs, self.chars = align, [], 0, 0
        self.sums: list[np.ndarray] = []
        self.digests: list = []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []  # document << 32 | number of a pair, and times

    def add(self, ids: pa.Array, texts: list[str | None]) -> None:
        first, work, size = self.docs, [], 0
        self.ids.append(ids)
        self.docs += len(texts)
        for doc, text in enumerate(texts, first):
            self.sums.append(np.zeros(4, np.int64))
            self.digests.append(hashlib.sha256() if text else None)
            self.chars += len(text or "")
            for part in _parts(" " + text, PIECE_CHARS if self.align.cuts else len(text) + 1) if text else ():
                work.append((doc, self.align.segments(part)))
                size += len(part)
                if size >= PIECE_CHARS:
                    self._align(work)
                    work, size = [], 0
        if work:
            self._align(work)

    def _align(self, work: list[tuple[int, list]]) -> None:
        known = self.align
        if len(known.memo) > MEMO_SEGMENTS or known.chars > MEMO_CHARS:
            known.clear()
        known.learn(set().union(*(own for _, own in work)))
        sums, starts, links = np.frombuffer(known.sums, np.int32), np.frombuffer(known.starts, np.int64), np.frombuffer(known.links or array("i", [0]), np.int32)
        sums, keys = sums.reshape(-1, 4), []
        for doc, own in work:
            at = [known.memo[s] for s in own]
            more = b";" if self.sums[doc].any() else b""
            self.digests[doc].update(more + b";".join([known.texts[i] for i in at]))
            at = np.array(at, np.int64)
            self.sums[doc] += sums[at].sum(axis=0, dtype=np.int64)
            keys.append(doc << 32 | at)
        keys, times = np.unique(np.concatenate(keys), return_counts=True)
        segment = keys & 0xFFFFFFFF
        n = starts[segment + 1] - starts[segment]
        places = np.repeat(starts[segment] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        self.held.append(_summed(np.repeat(keys & ~0xFFFFFFFF, n) | links[places], np.repeat(times, n)))

    def batches(self, name: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """One row per document, and one with the shard's distinct pairs and the number of its documents that hold each."""
        sums = np.array(self.sums)
        good = (sums[:, 3] == 0) & (sums[:, 0] > 0)
        sums[~good] = 0
        key, times = (np.concatenate(x) for x in zip(*self.held, strict=True)) if self.held else (np.zeros(0, np.int64),) * 2
        if (np.diff(key) <= 0).any():  # parts of one long text
            key, times = _summed(key, times)
        keep = good[key >> 32]
        doc, number, times = key[keep] >> 32, key[keep] & 0xFFFFFFFF, times[keep]
        here = np.zeros(len(self.align.pairs), bool)
        here[number] = True
        which, pairs = (np.cumsum(here) - 1)[number], np.fromiter(self.align.pairs, np.int64, len(here))[here]
        edges = pa.array(np.searchsorted(doc, np.arange(self.docs + 1)), pa.int32())
        of_docs = {
            "shard": pa.array([name] * self.docs), "doc_id": pa.chunked_array(self.ids).combine_chunks(),
            "n_a": pa.array(sums[:, 0]), "n_b": pa.array(sums[:, 1]), "n_groups": pa.array(sums[:, 2]), "n_links": pa.array(_run_sums(times, edges.to_numpy())),
            "groups_sha256": pa.array([d.hexdigest() if g else "" for d, g in zip(self.digests, good, strict=True)], pa.string()),
            "which": pa.ListArray.from_arrays(edges, pa.array(which, pa.int32())), "times": pa.ListArray.from_arrays(edges, pa.array(times, pa.int32())),
        }
        of_shard = {"shard": pa.array([name]), "pairs": pa.array([pairs], pa.list_(pa.int64())), "holders": pa.array([np.bincount(which, minlength=len(pairs))], pa.list_(pa.int32()))}
        for columns, n in ((of_docs, self.docs), (of_shard, 1)):
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their times."""
    by = np.argsort(key)
    key, times = key[by], times[by]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    return key[new], np.add.reduceat(times, new) if len(new) else times


def _run_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the runs between edges."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def linked_documents(docs: DataFrame, byte_tokenizer: str, piece_tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with their sums and pairs, and one row of distinct ``pairs`` per shard."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(byte_tokenizer, piece_tokenizer)
        part, number, shard, schema = TaskContext.get().partitionId(), 0, _Shard(align), None
        for batch in slices(batches):
            names = ["shard", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "which", "times", "pairs", "holders"]
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            kinds = [pa.string(), batch.column("id").type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), ints, ints, longs, ints]
            schema = schema or pa.schema(list(zip(names, kinds, strict=True)))
            shard.add(batch.column("id"), batch.column("text").to_pylist())
            if shard.chars >= SHARD_CHARS or shard.docs >= 1 << 16:
                yield from shard.batches(f"{part}-{number}", schema)
                number, shard = number + 1, _Shard(align)
        if shard.docs:
            yield from shard.batches(f"{part}-{number}", schema)

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(link, f"shard string, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, which array<int>, times array<int>, pairs array<long>, holders array<int>")


def align_tokens(docs: DataFrame, byte_tokenizer: str = "byte_bpe_50k.json", piece_tokenizer: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best: links whose count is the highest of their A id in the whole table, ties included. count_sum: the counts of all links.
    """
    linked = written(linked_documents(docs, byte_tokenizer, piece_tokenizer, id_col, text_col), "aligned")
    held = linked.where(F.col("pairs").isNotNull()).select("shard", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "p")).select("shard", "place", "p.pairs", "p.holders")
    counts = held.groupBy("pairs").agg(F.sum("holders").alias("count"))
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pairs", 32)))  # an A id has no more pairs than B has ids
    counts = counts.select("pairs", "count", (F.col("count") == highest).alias("best"))
    looked = held.select("shard", "place", "pairs").join(counts, "pairs").select(F.col("shard").alias("of"), "place", "count", "best")

    def total(own: pa.Table, looked: pa.Table) -> pa.Table:
        own, by = own.combine_chunks(), np.argsort(looked["place"].to_numpy())
        count, best = looked["count"].to_numpy()[by], looked["best"].to_numpy()[by].astype(np.int64)
        lists = own["which"].combine_chunks()
        edges, which, times = lists.offsets.to_numpy(), lists.values.to_numpy(), own["times"].combine_chunks().values.to_numpy().astype(np.int64)
        sums = [pa.array(_run_sums(values[which] * times, edges)) for values in (best, count)]
        return pa.table([*(own[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *sums, own["groups_sha256"]], names=[c.split()[0] for c in schema.split(", ")])

    schema = f"doc_id {linked.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return linked.where(F.col("pairs").isNull()).drop("pairs", "holders").groupBy("shard").cogroup(looked.groupBy("of")).applyInArrow(total, schema)
