import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from changeflow.llm import decontaminate as D, language as L, mixing as M, near_dedup as N, quality as Q, substring_dedup as S
from changeflow.llm.common import text_bytes

EDGES = [None, "", " \n\t", "one", "a b c d", "x " * 3000]


def text_rows(spark, name="documents"):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").select("doc_id", "text").collect()]


# near duplicates


def test_probability_jaccard():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ({rng.randint(0, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 15))} for _ in "ab")
        columns = lambda x: (np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)]))
        assert N.probability_jaccard(*columns(a), *columns(b)) == pytest.approx(brute.probability_jaccard(a, b))


def test_registers_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(1)
    ids, m = rng.integers(0, 1 << 44, 1000).astype(np.uint64), 4000
    a, b = np.sort(ids[:800]), np.sort(ids[100:])
    wa, wb = rng.integers(1, 4, 800), rng.integers(1, 4, 900)
    signs = N.prob_minhash(np.repeat([0, 1], [800, 900]), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, m)
    true = N.probability_jaccard(a, wa, b, wb)
    assert abs((signs[0] == signs[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / m)
    assert (N.prob_minhash(np.zeros(1, int), a[:1], wa[:1], 1, 64) == a[0]).all()


def test_near_duplicates_against_all_pairs(spark):
    rows = text_rows(spark)
    got = {r.doc_id: r.class_id for r in N.near_duplicate_classes(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    assert got == brute.near_classes(rows)


def test_many_classes_in_one_bucket(spark):
    """One register a band: buckets hold texts that are no copies of each other; later rounds must still find all links."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(60):
        own = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([10, 40, 60]))]
        rows.append((len(rows), " ".join(common + own)))
        if i % 3 == 0:
            rows.append((len(rows), " ".join(common + own[:-1] + ["z"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in N.near_duplicate_classes(df, bands=24, rows=1).collect()}
    assert got == brute.near_classes(rows)


def test_near_duplicates_of_odd_rows(spark):
    texts = [*EDGES, "A  b C d", "a b c d", "one", None]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "alone here", "x"), (None, "a b c d", "x"), (3, "one", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    out = N.near_duplicate_classes(df).collect()
    assert len(out) == len(rows)
    got = {(r.doc_id, r.class_id) for r in out}
    assert {(0, 0), (1, 1), (2, 2), (3, 3), (8, 3), (4, 4), (6, 4), (7, 4), (9, 9), (None, None), (None, 4)} <= got
    kept = N.keep_one(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 0), (False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (False, 9), (True, 0)]
    assert N.near_duplicate_classes(df.limit(0)).count() == 0


def test_chains_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.node: r["class"] for r in N.components(links).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# repeated passages


@pytest.mark.parametrize("hot", [S.HOT, 1])
def test_repeats_against_every_window(spark, hot):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["x y z " * 8] * 5 + EDGES
    rows = list(enumerate(texts))
    out = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=7, seed=3, hot=hot).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == brute.repeats(rows, 7)
    assert len(out) == len(rows)


def test_repeats_of_the_table(spark):
    out = S.remove_repeats(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == brute.repeats(text_rows(spark), 50)


def test_repeats_of_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(8))
    df = spark.createDataFrame([(1, passage, 0), (1, passage, 0), (None, passage + " end", 0), (2, None, 0)], "doc_id long, text string, gone int")
    out = S.remove_repeats(df, window=5, seed=2).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.kept) for r in out) == [(0, 8, "end"), (1, 0, passage), (1, 0, passage), (2, 0, "")]
    assert S.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("seen, hot", [(1000, S.HOT), (2, 1)])
def test_repeated_rows_are_packed_once(spark, monkeypatch, seen, hot):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("ab") for _ in range(30)) for _ in range(20)]
    own = dict(enumerate(texts))
    rows = [(i, t) for i, t in own.items() for _ in range(60 if i in (0, 7) else 1)] + [(None, texts[3] + " b a")] * 60
    rng.shuffle(rows)
    tables, write = {}, S.written
    monkeypatch.setattr(S, "SEEN", seen, raising=False)
    monkeypatch.setattr(S, "written", lambda df, label: tables.setdefault(label, write(df, label)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = S.remove_repeats(df, window=7, seed=3, hot=hot).collect()
    want = brute.repeats([*own.items(), (1 << 62, texts[3] + " b a")], 7)
    assert len(out) == len(rows)
    assert {(1 << 62 if r.doc_id is None else r.doc_id): (r.n_words, r.n_removed, r.kept_sha256) for r in out} == want
    packed = tables["kmer-packed"]
    assert packed.count() == packed.select("o", "c", "k", "at").distinct().count() > 0


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(S, "_spans", lambda words, start, end, second=False: np.zeros(len(start), np.uint64))
    raw, offsets = text_bytes(pa.array(["a b c", "x b c", "a b c d"]))
    row, at, size = S._repeats_in_bucket(raw, offsets, np.array([1, 2, 3]), 3)
    assert list(zip(row.tolist(), at.tolist(), size.tolist(), strict=True)) == [(2, 0, 3)]


# benchmark


def test_tiling_against_plain_search(monkeypatch):
    rng = random.Random(6)
    for _ in range(150):
        doc, item = [rng.choice("abc") for _ in range(rng.randint(4, 25))], [rng.choice("abc") for _ in range(rng.randint(4, 12))]
        block = D.Items.of([7], [" ".join(item)], 3, coverage=1e-9)
        words, rows = D.tokens(*text_bytes(pa.array([" ".join(doc)])))
        found = D._matches(block, words, rows, 3, 1e-9)
        share = found[0][0][1] if found else 0.0
        assert round(share * len(item)) == brute.tiling(doc, item, 3)
        every = [tuple(x.tolist() for x in D.maximal_matches(words, block.tokens, at, np.arange(len(block.own)), seed, block.own, 3)) for at, seed in [_seeds(block, words)]]
        monkeypatch.setattr(D, "MOST_HITS", 0)
        runs = D._run_matches(words, block.tokens, _seeds(block, words)[0], 3)
        assert sorted(zip(*every[0])) == sorted(zip(*(x.tolist() for x in runs)))
        monkeypatch.undo()


def _seeds(block, words):
    from changeflow.llm.common import gram_hashes

    grams, at = gram_hashes(words, np.zeros(len(words), int), 3)
    seed = np.minimum(np.searchsorted(block.seeds, grams), len(block.seeds) - 1)
    return at[block.seeds[seed] == grams], seed[block.seeds[seed] == grams]


def test_leaks_of_a_table_by_definition(spark):
    """Every document against every item by plain tiling."""
    docs, items = text_rows(spark)[:120], [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rng = random.Random(3)
    for i, t in items[:12]:  # reordered and partial copies
        w = t.split()
        docs.append((10**6 + i, " ".join(w[len(w) // 2 :] + ["zz"] + w[: rng.randint(2, len(w) // 2)])))
    cut = lambda t: D.tokens(*text_bytes(pa.array([(t or "").lower()])))[0].tolist()
    want = set()
    tokens = [(i, cut(t)) for i, t in items]
    for d, t in docs:
        own = cut(t)
        near = {tuple(own[p : p + 4]) for p in range(len(own) - 3)}
        for i, item in tokens:
            if any(tuple(item[p : p + 4]) in near for p in range(len(item) - 3)):
                if brute.tiling([x if x in set(item) else -p for p, x in enumerate(own)][:3000], item, 4) >= 0.5 * len(item):
                    want.add((d, i))
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS matches")
    got = {(r.doc_id, m.item_id) for r in D.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect() for m in r.matches}
    assert got == want and len(want) > 10


def test_frequent_seeds_and_repeated_words_stay_cheap():
    """Many items share a phrase, and text and item repeat one word: neither lists all pairs of places."""
    import resource
    import time

    rng = random.Random(1)
    word = lambda: "w%d" % rng.randint(0, 10**7)
    block = D.Items.of(list(range(20_000)), [" ".join([*(word() for _ in range(8)), "which of the following is", *(word() for _ in range(8))]) for _ in range(20_000)], 4)
    text = " ".join(" ".join(word() for _ in range(20)) + " which of the following is" for _ in range(80))
    same = D.Items.of([1], ["a " * 500], 4)
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
    assert D._matches(block, *D.tokens(*text_bytes(pa.array([text]))), 4, 0.5) == {}
    found = D._matches(same, *D.tokens(*text_bytes(pa.array(["a " * 100_000]))), 4, 0.5)
    assert found[0][0][1:] == (1.0, [(0, 0, 500)])
    assert time.process_time() - start < 8 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000


def test_reordered_passages_are_found(spark):
    item = [f"t{i}" for i in range(20)]
    clean = " ".join(f"z{i}" for i in range(40))
    docs = [(1, " ".join(item)), (2, " ".join(["q"] * 5 + item[10:] + ["q"] + item[:10])), (3, " ".join(item[:8])), (4, clean), (5, None), (6, ""), (None, " ".join(item).upper()), (1, " ".join(item))]
    df = spark.createDataFrame([(i, t, "m") for i, t in docs], "doc_id long, text string, matches_ string")
    bench = spark.createDataFrame([(9, " ".join(item)), (8, "t0 t1"), (7, None), (9, ", ".join(item))], "item_id long, text string")
    for block in (D.BLOCK_TOKENS, 10):
        out = D.find_leaks(df, bench, block_tokens=block).collect()
        assert len(out) == len(docs)
        hit = {(r.doc_id, tuple(m.item_id for m in r.matches)) for r in out}
        assert hit == {(1, (9, 9)), (2, (9, 9)), (3, ()), (4, ()), (5, ()), (6, ()), (None, (9, 9))}
    tiles = next(r for r in out if r.doc_id == 2).matches[0].tiles
    assert [(t.doc_start, t.item_start, t.length) for t in tiles] == [(5, 10, 10), (16, 0, 10)]
    assert D.find_leaks(df.limit(0), bench).count() == 0
    assert D.find_leaks(df, bench.limit(0)).where(F.size("matches") > 0).isEmpty()


def test_tokens_by_unicode_class():
    cut = lambda t: D.tokens(*text_bytes(pa.array([t])))[0].tolist()
    same = [("“la maison” – c’est «ça»…", 'la maison - c\'est "ça"...'), ("今天，天气很好。", "今 天 天 气 很 好"), ("ภาษาไทย", " ".join("ภาษาไทย")), ("ab日本12", "ab 日 本 12"), ("カタカナ・ー", "カ タ カ ナ ー"), ("हिन्दी में", "हिन्दी, में"), ("5€ ☃☃", "5 € ☃ ☃"), ("𠀀𠀁x", "𠀀 𠀁 x")]
    for a, b in same:
        assert cut(a) == cut(b) and len(cut(a)) == len(b.replace(",", " ").replace("-", " ").replace("'", " ").replace('"', " ").replace(".", " ").split())
    hashes, rows = D.tokens(*text_bytes(pa.array(["日本", "", "本x", None, "—"])))
    assert rows.tolist() == [0, 0, 2, 2] and hashes[1] == hashes[2]


def test_items_without_spaces_and_of_few_words_are_found(spark):
    chinese, three, one = "中国的首都是哪一座城市？", "Quo vadis, domine", "xylograph"
    docs = [(1, f"前言：{chinese}后记"), (2, "«quo» vadis — domine?"), (3, "quo vadis"), (4, "a Xylograph, a xylograph"), (5, "中国很大"), (6, None), (7, chinese), (7, chinese)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, chinese), (2, three), (3, three.upper()), (4, one), (5, "?!"), (6, None)], "item_id long, text string")
    for block in (D.BLOCK_TOKENS, 5):
        out = D.find_leaks(df, bench, block_tokens=block, shortest=1).collect()
        assert sorted((r.doc_id, sorted(m.item_id for m in r.matches)) for r in out) == [(1, [1]), (2, [2, 3]), (3, []), (4, [4]), (5, []), (6, []), (7, [1]), (7, [1])]
        tiles = {(r.doc_id, m.item_id): [tuple(t) for t in m.tiles] for r in out for m in r.matches}
        assert tiles[1, 1] == [(2, 0, 11)] and tiles[2, 3] == [(0, 0, 3)] and tiles[4, 4] == [(1, 0, 1)]


# mixing


def test_targets():
    t = M.target_words({"b": 100, None: 10, "a": 1, "c": 1000})
    assert t["a"] == 3  # 5 of 9 weights, but one word alone
    assert sum(t.values()) == pytest.approx(1111)
    assert t["b"] == 300 and t[None] == 30
    assert M.target_words({}) == {}
    assert M.target_words({"a": 0}) == {"a": 0.0}


def test_budgets_are_met_as_well_as_sizes_allow():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 12)
        sizes, counts = np.array(rng.sample(range(0, 60), n)), np.array([rng.randint(1, 5) for _ in range(n)])
        budget = rng.randint(0, int((sizes * counts).sum()))
        reach = {0}
        for s, c in zip(sizes.tolist(), counts.tolist(), strict=True):
            reach = {r + k * s for r in reach for k in range(c + 1)}
        take = M.fit_budget(sizes, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        assert int((take * sizes).sum()) == max(r for r in reach if r <= budget)
    sizes, counts = np.arange(1, 3000), np.full(2999, 50)
    assert int((M.fit_budget(sizes, counts, 123_456_789) * sizes).sum()) == 123_456_789


def test_mix(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None), (10**6 + 1, "", "src1"), (None, "two words", None), (10**6 + 2, "same text", "z"), (10**6 + 2, "same text", "z")], "doc_id long, text string, source string")
    rows = docs.select("doc_id", "text", "source").unionByName(odd)
    out = M.mix(rows).collect()
    assert len(out) == rows.count()
    total = sum(r.size for r in out)
    for r in out:
        assert r.taken == r.size * r.copies <= 3 * r.size
    taken = sum(r.taken for r in out)
    assert abs(taken - total) < 0.02 * total
    assert sorted((str(r.doc_id), r.taken) for r in M.mix(rows.repartition(7)).collect()) == sorted((str(r.doc_id), r.taken) for r in out)
    copies = sum(r.copies for r in out)
    mixed = M.apply_mix(rows)
    assert mixed.count() == copies and mixed.columns == rows.columns
    assert M.mix(rows.limit(0)).count() == 0


def test_rows_of_one_id_and_text_stay_in_their_source(spark):
    rows = [(1, "a b c d", "s1", "u1"), (1, "a b c d", "s2", "u2"), (1, "a b c d", "s2", "u3"), (None, None, None, "u4")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __id string")
    taken = {s: [r for r in M.apply_mix(df, weights=(1.0, 0.0)).collect() if r.source == s] for s in ("s1", "s2")}
    assert len(taken["s1"]) == 3 and not taken["s2"] and {r["__id"] for r in taken["s1"]} == {"u1"}


def test_one_row_is_kept_of_each_class(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join(words), " ".join([*words[:-1], "zz"])
    rows = [(i, t, "q") for i in (None, None, 7, 7) for t in near] + [(8, " ".join(words[1:]), "q"), (9, "other text of five words", "a"), (9, "other text of five words", "b")]
    rows += [(None, None, "n1"), (None, "", "n2"), (5, " ", "n3"), (5, None, "n3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string")
    out = N.keep_one(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 5), (False, 7), (False, 9), (True, 0), (True, 0)]
    assert {r["__id"] for r in out if r.doc_id is None} == {"n1", "n2"} and N.keep_one(df.limit(0)).count() == 0


def test_result_names_replace_columns(spark):
    df = spark.createDataFrame([(1, "und der die das", 9.0, "x", 0)], "doc_id long, text string, score double, lang_pred string, matches int")
    assert Q.score(df, None).select("score").first() == (0.5,)
    assert L.identify(df, None).select("lang_pred", "score").first() == ("und", 0.0)
    assert D.find_leaks(df, df.select(F.col("doc_id").alias("item_id"), "text")).select(F.size("matches")).first() == (1,)


def test_samples_are_bounded_in_rows(spark, monkeypatch):
    rows = [(1, "same text here")] * 3000 + [(i, f"text number {i}") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    seen = []
    monkeypatch.setattr(Q, "fit_quality", lambda good, web, prior: seen.append((len(good), len(web))))
    Q.learn(docs, labels, F.lit(True), positives=20, unlabelled=1000)
    assert seen == [(20, 39)]


def test_choice_of_documents_follows_the_count(spark):
    """One size holds all rows: the cells of two levels and the last rank must add up to the number wanted."""
    rows = spark.createDataFrame([(i, i, "s", 10) for i in range(5000)], "id long, content long, source_key string, size long").withColumn("h", F.xxhash64("id"))
    for need in (1, 777, 4999, 5000):
        wanted = spark.createDataFrame([("s", 10, need)], "source_key string, size long, need long")
        out = M._first_by_hash(rows, wanted).agg(F.count("*"), F.sum("more")).first()
        assert tuple(out) == (5000, need)


# classifiers


def test_language_learns_and_holds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.learn(docs, F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0)
    out = [r for r in L.identify(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 !?", "x"), (None, "und der die das ist nicht", "x"), (5, "the of " * 20_000, "x")], "doc_id long, text string, s string")
    out = {r.doc_id: r for r in L.identify(odd, model).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and out[1].score == 0
    assert out[None].lang_pred == "de" and out[5].lang_pred == "en" and 0 <= out[5].score <= 1
    assert L.learn(docs.limit(0), F.lit(True)) is None
    assert {r.lang_pred for r in L.identify(odd, None).collect()} == {"und"}


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    w = {"ef": rng.normal(0, 0.5, (9, 257)), "eb": rng.normal(0, 0.5, (9, 257)), "uf": rng.normal(0, 0.5, (9, 3)), "ub": rng.normal(0, 0.5, (9, 3)), "vf": rng.normal(0, 1, (2, 3)), "vb": rng.normal(0, 1, (2, 3)), "c": np.zeros((2, 1))}
    w = {k: v.astype(np.float64) for k, v in w.items()}
    ids = np.array([[1, 2], [2, 1], [3, 256], [1, 256]])
    targets = np.array([0, 1])

    def loss(w):
        total = 0.0
        f, b = L._forward(w["ef"], w["uf"], ids, range(4)), L._forward(w["eb"], w["ub"], ids, range(3, -1, -1))
        for t in range(4):
            p = w["vf"] @ f[t][-1] + w["vb"] @ b[t][-1] + w["c"]
            p = np.exp(p - p.max(0)) / np.exp(p - p.max(0)).sum(0)
            total -= sum(np.log(p[targets[j], j]) for j in range(2) if ids[t, j] != L.PAD)
        return total / 6

    g = L._gradients(w, ids, targets)
    for k in w:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w[k].shape)
            if k in ("ef", "eb"):
                at = (at[0], int(rng.choice([1, 2, 3])))
            up, down = ({n: v.copy() for n, v in w.items()} for _ in "ab")
            up[k][at] += 1e-3
            down[k][at] -= 1e-3
            assert g[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-3, abs=2e-4)


def test_windows_do_not_depend_on_the_batch(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = L.learn(docs, F.lit(True), rows=50)
    texts = [r.text for r in docs.select("text").limit(40).collect()]
    together = model.probabilities(*text_bytes(pa.array(texts)))
    alone = np.concatenate([model.probabilities(*text_bytes(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone, atol=1e-4)
    assert np.allclose(together.sum(1), 1, atol=1e-3)


def test_quality_holds_on_unseen_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = Q.learn(docs, labels, F.pmod(F.crc32("id"), F.lit(4)) != 2)
    held = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    out = {r.doc_id: r.score for r in Q.score(docs, model).select("doc_id", "score").collect()}
    assert sum((out[i] >= 0.7) == (q == 1) for i, q in held.items()) / len(held) > 0.9
    odd = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(EDGES)] + [(None, "a", 0.0)], "doc_id long, text string, f double")
    scores = {r.doc_id: r.score for r in Q.score(odd, model).collect()}
    assert len(scores) == len(EDGES) + 1 and scores[0] == scores[1] == 0 and all(0 <= s <= 1 for s in scores.values())
    assert Q.learn(docs, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in Q.score(odd, None).collect()} == {0.5}
    assert Q.score(odd.limit(0), model).count() == 0


def test_prior_of_known_mixtures():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        good = lambda n: rng.normal(1.5, 1, (n, 4))
        web = np.concatenate([good(int(4000 * share)), rng.normal(-1.5, 1, (4000 - int(4000 * share), 4))])
        model = Q.fit_quality(good(3000), rng.permutation(web))
        assert abs(model.prior - share) < 0.08


def test_blocks_of_pivots_lose_no_link():
    rng = np.random.default_rng(7)
    base = np.sort(rng.choice(10**6, 60, replace=False)).astype(np.uint64)
    texts = []
    for i in range(60):
        ids = np.unique(np.concatenate([base[: rng.integers(30, 60)], rng.choice(10**6, rng.integers(0, 12)).astype(np.uint64)]))
        texts.append((i, i % 7, ids, rng.integers(1, 3, len(ids)) if i % 2 else np.ones(len(ids), np.int64)))
    block = N._Block(0.8)
    for t in texts[:40]:
        block.add(*t)
    some = 0
    for node, group, ids, weights in texts:
        want = [p for p, g, i, w in texts[:40] if p < node and g != group and N.probability_jaccard(i, w, ids, weights) >= 0.8]
        some += len(want)
        assert sorted(block.links(node, group, ids, weights)) == want
    assert some > 20


def test_packed_texts_are_cut_by_their_unpacked_size():
    """Repetitive texts pack to almost nothing; what is unpacked at once stays bounded."""
    import pyarrow as pa
    import zstandard

    from changeflow.llm import near_dedup

    texts = [b"the same line again and again\n" * n for n in (10, 2_000, 2_000, 50_000, 1, 2_000)]
    batch = pa.RecordBatch.from_arrays([pa.array([zstandard.ZstdCompressor(level=1).compress(t) for t in texts], pa.binary())], names=["packed"])
    assert batch.nbytes < 10_000
    cut = list(near_dedup.unpacked_slices(iter([batch]), 100_000))
    assert pa.Table.from_batches(cut).column("packed").to_pylist() == batch.column("packed").to_pylist()
    sizes = [sum(len(zstandard.ZstdDecompressor().decompress(p.as_py())) for p in b.column("packed")) for b in cut]
    assert all(s <= 100_000 or b.num_rows == 1 for s, b in zip(sizes, cut, strict=True))


def test_pivots_in_small_steps(monkeypatch):
    """Links do not depend on how many common shingles are looked at together."""
    import numpy as np

    from changeflow.llm import near_dedup

    rng, found = np.random.default_rng(1), []
    sets = [(np.unique(np.concatenate([np.arange(200), rng.integers(200, 240, 30)])).astype(np.uint64)) for _ in range(40)]
    for hits in (1 << 20, 7):
        monkeypatch.setattr(near_dedup, "HITS", hits)
        block = near_dedup._Block(0.9)
        for i, ids in enumerate(sets[:30]):
            block.add(i, i, ids, np.ones(len(ids)))
        found.append([block.links(100 + i, 100 + i, ids, np.ones(len(ids))) for i, ids in enumerate(sets)])
    assert found[0] == found[1] and any(found[0])
