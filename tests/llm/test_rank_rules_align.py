import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from tokenizers import Tokenizer

from changeflow.llm import alignment as A, host_rules as H, lexical as X, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EDGES = [None, "", " \n\t", "...", "one", "One ONE one", "ÀÉ àé", "日本 語", "x y " * 3000, "a-b_c", "Σς ß"]


# ranked search


def ranked(docs, items, k):
    """By definition: [(item_id, rank, doc_id, score)], every row by itself."""
    split = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    split = [(i, c, sum(c.values())) for i, c in split if c]
    n_docs, total = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = []
    for item, text in items:
        asked = sorted(set(TERM.findall((text or "").translate(LOWER))) & df.keys())
        scores = []
        for i, c, n in split:
            m = 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def plain(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_search_by_definition(spark, monkeypatch):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{SMALL}/{t}.parquet").select(*c).collect()]
    docs, items = read("documents", "doc_id", "text"), read("benchmark", "item_id", "text")
    want = plain(ranked(docs, items, 50))
    assert plain(tuple(r) for r in queries.op11_lexical_search(spark, SMALL).collect()) == want
    monkeypatch.setattr(X, "SHARD_DOCS", 7)  # many shards of few documents, several blocks of items
    got = X.search(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3), spark.read.parquet(f"{SMALL}/benchmark.parquet"), k=5, block_items=3)
    assert plain(tuple(r) for r in got.collect()) == plain(ranked(docs, items, 5))


def test_search_of_odd_rows(spark):
    """Nulls, ties, repeated rows and ids, clashing names, long texts."""
    docs = [(i, t) for i, t in enumerate(EDGES)] + [(3, "one two"), (None, "one"), (None, "one"), (4, "one"), (40, "one"), (41, "one"), (None, None)]
    items = [(1, "ONE two missing"), (1, "one"), (None, "日本 x"), (2, ""), (3, None), (4, "àé ÀÉ b")]
    d = spark.createDataFrame([(i, t, "z", 1) for i, t in docs], "doc_id long, text string, term string, score int")
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    out = X.search(d, q, k=4)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(tuple(r) for r in out.collect()) == plain(ranked(docs, items, 4))
    assert X.search(d.limit(0), q).count() == 0
    assert X.search(d, q.limit(0)).count() == 0


def test_search_of_a_long_text(spark, monkeypatch):
    import changeflow.llm.common as C

    monkeypatch.setattr(C.pieces, "__defaults__", (C.pieces.__defaults__[0], 100))
    text = "alpha beta " * 300 + "x" * 1000 + " gamma"
    assert sum(len(rows) for _, _, _, rows in X.find_terms(__import__("pyarrow").array([text]))) == 602
    docs = [(1, text), (2, "gamma alpha")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = X.search(d, spark.createDataFrame([(7, "gamma beta")], "item_id long, text string"))
    assert plain(tuple(r) for r in got.collect()) == plain(ranked(docs, [(7, "gamma beta")], 50))


def test_accumulators_are_limited_and_exact():
    rng = np.random.default_rng(5)
    limited = 0
    for _ in range(300):
        size, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        terms = [np.sort(rng.choice(size, int(rng.integers(1, size + 1)), replace=False)) for _ in range(int(rng.integers(1, 9)))]
        terms.sort(key=len)
        postings = [(t, rng.integers(1, 50, len(t)) * int(1 + 2000 / len(t))) for t in terms]
        full = np.zeros(size, np.int64)
        for t, p in postings:
            full[t] += p
        best, scores, created = X.best_documents(postings, size, k)
        want = np.lexsort((np.arange(size), -full))[:k]
        want = want[full[want] > 0]
        assert best.tolist() == want.tolist() and scores.tolist() == full[want].tolist()
        limited += created < (full > 0).sum()
    assert limited > 50


# host rules


def repeated(words, window=8):
    grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    n = Counter(grams)
    return len({p for i, g in enumerate(grams) if n[g] > 1 for p in range(i, i + window)})


def test_features_by_definition(spark):
    rng = random.Random(2)
    texts = [*EDGES, "a b c d e f g h " * 5, "a b c d e f g h", "a a a a a a a a a", "l1 x\nl1 x\n\n \nl1 x\r\nl2", "#$% &|<> *é日", *[" ".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(80)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'h' AS source", "1 AS n_words", "2 AS words")
    got = {r.doc_id: r for r in H.features(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines), len(lines) - len(set(lines)), repeated(words))
        assert tuple(got[i])[2:] == want, t


def test_prior_shrinks_small_hosts():
    mean, strength = H.beta_prior(3, 300, 30, 10**2 / 100 * 3, 3 * 100.0**2)
    assert mean == 0.1 and strength == 300  # hosts do not differ
    failed, sizes = [90, 5, 0], [100, 100, 2]
    mean, strength = H.beta_prior(3, 202, 95, sum(f * f / n for f, n in zip(failed, sizes, strict=True)), float(sum(n * n for n in sizes)))
    assert 1 <= strength < 20
    assert (90 + mean * strength) / (100 + strength) > 0.8 > 0.5 > (0 + mean * strength) / (2 + strength) > 0.1
    assert H.beta_prior(1, 5, 5, 5.0, 25.0) == (1.0, 5.0) and H.beta_prior(0, 0, 0, 0.0, 0.0) == (0.0, 1.0)


def test_host_verdicts(spark):
    words = [f"word{i}" for i in range(30)]
    good, bad = " ".join(words), "few words"
    rows = [(i, good if i % 40 else bad, f"good{i % 5}") for i in range(400)] + [(1000 + i, bad if i % 10 else good, "bad") for i in range(100)]
    rows += [(2000, good, None), (2001, bad, None), (None, good, "bad"), (None, None, "tiny"), (2002, good, "tiny"), (2002, good, "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "0 AS host", "1 AS n", "true AS kept")
    out = H.judge(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.base_failed == (r.n_words < 20)
        assert r.kept == (not r.base_failed and r.host != "bad"), r
    assert [r.host_rate for r in out if r.doc_id == 2000] == [None]
    assert H.judge(df.limit(0)).count() == 0


def test_host_rules_have_no_python_workers(spark):
    plan = queries.op12_host_rules(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# token alignment


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), A.Aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def aligned(texts, tokenizers):
    """By decoded bytes of whole texts: per text its A and B ids, group text and links."""
    a, b, known = tokenizers
    out = []
    for text in texts:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        ends = []
        for ids, table in ((x, known.a_bytes), (y, known.b_bytes)):
            ends.append(np.cumsum([len(table[i]) for i in ids]).tolist())
            if b"".join(table[i] for i in ids) != (" " + (text or "")).encode():
                x = []
        if not x or not y:
            out.append((0, 0, 0, [], ""))
            continue
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for e in both:
            m, n = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, x[i:m])) + "|" + ",".join(map(str, y[j:n])))
            i, j = m, n
        starts = [[0, *e[:-1]] for e in ends]
        links, j0 = [], 0
        for i in range(len(x)):
            while ends[1][j0] <= starts[0][i]:
                j0 += 1
            j = j0
            while j < len(y) and starts[1][j] < ends[0][i]:
                links.append((x[i], y[j]))
                j += 1
        out.append((len(x), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def digests(rows, tokenizers):
    found = aligned([t for _, t in rows], tokenizers)
    count = Counter(p for f in found for p in set(f[3]))
    most: dict = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    return [(i, na, nb, g, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), sha) for (i, _), (na, nb, g, links, sha) in zip(rows, found, strict=True)]


def odd_texts(n):
    rnd, parts = random.Random(8), [*" \n\t\r\x0b\x0c\x1c\x85  　", "́", "é", "日", "𓀀", "😀", "▁", "<0x41>", "<|endoftext|>", "</s>", "word", " word", "  ", "'ll", "\x00", ".", ", ", "12"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(n)]


def test_alignment_by_definition(spark, tokenizers):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert plain(tuple(r) for r in queries.op13_token_alignment(spark, SMALL).collect()) == plain(digests(rows, tokenizers))


def test_alignment_of_odd_texts(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(A, "PIECE_CHARS", 40)  # texts in several parts, several shards a task
    monkeypatch.setattr(A, "SHARD_CHARS", 500)
    monkeypatch.setattr(A, "MEMO_SEGMENTS", 20)
    texts = [None, "", " ", "  ", "a", "a ", "a  ", "<|endoftext|> x", "x" * 500, *odd_texts(300), "word word word " * 40, "word word word " * 40]
    rows = [*enumerate(texts), (None, "a b"), (None, None), (5, "a b")]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, shard string").repartition(4)
    got = A.align_tokens(df)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert plain(tuple(r) for r in got.collect()) == plain(digests(rows, tokenizers))
    assert A.align_tokens(df.limit(0)).count() == 0


def test_spans_agree_with_bytes(tokenizers):
    known = tokenizers[2]
    assert known.cuts
    for text in odd_texts(500):
        e, p = known.a.encode(" " + text, add_special_tokens=False), known.b.encode(text, return_type="proto").pieces
        at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in " " + text])])
        ends = A.token_ends([int(at[y]) for _, y in e.offsets], e.ids, known.a_bytes, known.a_whole)
        assert ends == np.cumsum([len(known.a_bytes[i]) for i in e.ids]).tolist()
        if "▁" not in text:
            assert A.token_ends([x.end + 1 for x in p], [x.id for x in p], known.b_bytes, known.b_whole) == np.cumsum([len(known.b_bytes[x.id]) for x in p]).tolist()
