import random

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.llm import token_counts as C, token_files as T
from changeflow.llm.segments import encoder

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"
MARKS = " \n\t\r\x0b\x0c\x1c\x85  ̧́aAeéÉΣσßİ'sSllD12٣,.!?<|>#$ñ日​😀ªÀ"


def junk(n: int, seed: int = 1) -> list[str]:
    rnd, parts = random.Random(seed), [*MARKS, "<|endoftext|>", "<|startoftext|>", "'ll", "  ", "word", " Word,"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_segments_give_the_ids_of_whole_texts(name):
    enc, tok = encoder(name), Tokenizer.from_file(public_tokenizers.path(name))
    assert enc.cut is not None
    texts = junk(3000)
    for _ in range(2):  # without and with a filled memo
        for text, ids in zip(texts, enc.encode(texts), strict=True):
            assert np.frombuffer(ids, enc.kind).tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_memo_is_bounded(monkeypatch):
    import changeflow.llm.segments as S

    monkeypatch.setattr(S, "MEMO_ENTRIES", 50)
    enc = S.SegmentEncoder(public_tokenizers.path(BYTES))
    texts = [f" w{i} x{i}." + "y" * 100 for i in range(200)]
    for i in range(0, 200, 10):
        assert enc.encode(texts[i : i + 10]) == enc.whole(texts[i : i + 10])
        assert len(enc.memo) <= 100


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_chunks_are_spliced_exactly(name):
    enc = encoder(name)
    texts = ["word " * 900, "x" * 3000 + " y" * 500, "a" * 5000, " ".join(junk(80, 5)).replace("\x1c", ""), "\n\n  \n" * 300 + "end", "Ünï, " * 700]
    for text in texts:
        for chunk, overlap in ((200, 16), (64, 8), (1000, 1)):
            assert C.count_in_chunks(enc, text, chunk, overlap)[0] == len(enc.whole([text])[0]) // enc.kind.itemsize


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=MARKS.replace("\x1c", ""), max_size=300))
def test_chunks_of_any_text(text):
    enc = encoder(BYTES)
    assert C.count_in_chunks(enc, text, 40, 4)[0] == len(enc.whole([text])[0]) // enc.kind.itemsize


def test_counts(spark):
    tok = Tokenizer.from_file(public_tokenizers.path(BYTES))
    texts = [None, "", " ", "one two", "word " * 2000, *junk(50)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "x", ""), (3, "one two", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = C.token_counts(df, BYTES, limit=512, chunk_chars=500, overlap_chars=32).collect()
    assert len(out) == len(rows)
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in out) == want
    assert {r.doc_id for r in out if r.over_limit} == {i for i, _, n in want if n > 512}
    assert C.token_counts(df.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("planes", ["bits", "bytes"])
@pytest.mark.parametrize("ids", [[], [0], [1, 2, 3], [2**32 - 1, 0, 65536], list(range(70_000))])
def test_block_round_trip(planes, ids):
    block = T.pack_block(np.array(ids, np.uint32), planes)
    assert T.unpack_block(block).tolist() == ids
    if len(ids) > 1000:
        assert len(block) < len(ids)
    with pytest.raises(ValueError):
        T.unpack_block(b"????" + block[4:])


@pytest.mark.parametrize("planes, block_ids", [("bytes", 64), ("bits", 1 << 16)])
def test_files(spark, shared, planes, block_ids):
    texts = [None, "", "Some words, and more.", "long " * 500, *junk(60)]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int").repartition(5)
    T.write_token_files(df, shared, WORDS, block_ids=block_ids, planes=planes, shards=4)
    tok = Tokenizer.from_file(public_tokenizers.path(WORDS))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.read_token_files(spark, shared).collect()}
    assert got == brute.token_rows(rows, tok)
    ids = {r.doc_id: r.ids for r in T.read_documents(spark, shared).collect()}
    assert ids == {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    blocks = spark.read.parquet(shared)
    assert blocks.where(F.col("n_ids") > block_ids).isEmpty()


def test_files_of_repeated_and_null_ids(spark, shared):
    df = spark.createDataFrame([(5, "b"), (5, "a"), (5, "a"), (None, "n"), (None, None)], "doc_id long, text string")
    T.write_token_files(df, shared, WORDS, shards=2)
    out = sorted(T.read_token_files(spark, shared).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == [None, None, 5, 5, 5]
    assert [r.start for r in out] == [0, 1, 3, 5, 7]
    T.write_token_files(df.limit(0), shared + "-empty", WORDS)
    assert T.read_token_files(spark, shared + "-empty").count() == 0
