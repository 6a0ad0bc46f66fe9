"""Token counts of whole texts; huge texts in overlapping chunks that are spliced where both encodings provably agree.

Nulls and empty texts have no bytes and no tokens. Repeated rows and null ids are counted row by row; columns other than the id and the
text are not read, so clashing names do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import slices
from changeflow.llm.segments import SegmentEncoder, encoder

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256

# Where a pattern-splitting tokenizer always starts a new piece: white space after a character that is none. Control characters 1c-1f are
# white space for Python alone and never count.
_EDGE = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \t\n\r\f\v 　])")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), n_chunks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
            counts, chunks = [0] * len(texts), [1] * len(texts)
            size = enc.kind.itemsize
            for i, ids in zip(short, enc.encode([texts[i] for i in short]), strict=True):
                counts[i] = len(ids) // size
            for i in set(range(len(texts))).difference(short):
                counts[i], chunks[i] = count_in_chunks(enc, texts[i], chunk_chars, overlap_chars)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_()), pa.array(chunks, pa.int32())],
                names=["id", "n_bytes", "n_tokens", "over_limit", "n_chunks"],
            )

    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_chunks int")
    return out.withColumnRenamed("id", id_col)


def count_in_chunks(enc: SegmentEncoder, text: str, chunk: int, overlap: int) -> tuple[int, int]:
    """Tokens of a long text and the number of chunks it took.

    Each chunk starts ``overlap`` characters before the end of the last one. Both encodings are cut at the last edge in the overlap that
    is provably stable (a new piece starts there whatever stands around it) and that is a token start in both. Without such an edge the
    overlap doubles, up to the whole chunk; then the chunk itself grows.
    """
    if enc.cut is None or re.search(r"[\x1c-\x1f]", text):
        return len(enc.whole([text])[0]) // enc.kind.itemsize, 1
    tok, at, total, n = enc.tokenizer, 0, 0, 0
    carried = None  # (offsets of the tokens of the current chunk, its end)
    size = chunk
    while at < len(text):
        end = min(len(text), at + size)
        starts = carried if carried is not None else _token_starts(tok, text, at, end)
        carried = None
        n += 1
        if end == len(text):
            return total + len(starts), n
        back = min(overlap, end - at - 1)
        while True:
            low = end - back
            follow_end = min(len(text), low + size)
            edges = [m.start() for m in _EDGE.finditer(text, low, end - 1)]
            found = None
            if edges:
                # the following chunk starts at the overlap's first character; what it says up to its first stable edge may be wrong
                after = _token_starts(tok, text, low, follow_end)
                both = set(starts).intersection(after)
                # at a stable edge either a token starts, or (white space has no tokens of its own) the next token starts behind it
                found = next((e for e in reversed(edges) if e > low and _agree(starts, after, e, end, both)), None)
            if found is not None or back >= end - at - 1:
                break
            back = min(2 * back, end - at - 1)
        if found is None:
            size *= 2  # no stable edge in the whole chunk: widen it
            continue
        total += sum(s < found for s in starts)
        carried_starts = [s for s in after if s >= found]
        at, size = found, chunk
        if follow_end > at:
            carried, size = carried_starts, follow_end - at
    return total, n


def _token_starts(tok, text: str, a: int, b: int) -> list[int]:
    return [a + s for s, _ in tok.encode(text[a:b], add_special_tokens=False).offsets]


def _agree(starts: list[int], after: list[int], edge: int, end: int, both: set[int]) -> bool:
    """Whether the two encodings give the same next token start at or behind the edge."""
    nxt = next((s for s in after if s >= edge), None)
    return nxt is not None and nxt < end and nxt in both and next((s for s in starts if s >= edge), None) == nxt
