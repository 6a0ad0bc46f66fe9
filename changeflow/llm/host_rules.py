"""Host-level quality rules: failures of document rules by host, rates shrunk with an empirical beta prior, host verdicts joined back.

Per document, from its whole text: words (runs outside space and 0x09-0x0D), their characters, symbols, lines that repeat an earlier line, and words in
windows of ``WINDOW`` words that stand twice or more in the text. A document fails its base when it has fewer than ``LEAST_WORDS`` words or when over
``MOST_REPEATED`` percent of its words are repeated.

Per host and rule (``RULES``): the failing documents among all. Host rates scatter around the corpus rate by chance and by nature; the between-host part, by
analysis of variance over all hosts, gives the strength of a beta prior, and each rate is its posterior mean. So a host of few documents stays near the
corpus rate, and one of many keeps its own. A host with a rate above ``HOST_LIMIT`` for some rule is rejected with all its documents.

DataFrame functions only. Repeated windows are found by 64-bit hashes within one document, confirmed by their words. The document features are written
once, narrow; hosts meet documents by equality, so a hot host is one row of a small table that Spark broadcasts or splits. Five sums per rule come to the driver.

Defined results: null and empty texts have no words and fail their base; rows without host are judged by their base alone and count for no host; repeated rows and
null ids are judged and counted one by one; a single host, or hosts that differ no more than by chance, all get the corpus rate; an empty table gives an empty
result. A text of any length is one row of word arrays, some 100 bytes of memory a word. Other columns are not read; the result's names are fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from changeflow.llm.common import written

WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
HOST_LIMIT = 0.5
SPACE = r" \t\n\x0B\f\r"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rule name -> whether a document fails it.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "odd_words": "word_chars < 3 * n_words or word_chars > 12 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
}


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of every row."""
    text, words, lines = F.col("text"), F.col("words"), F.col("lines")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", "host",
        F.regexp_extract_all("text", F.lit(f"[^{SPACE}]+"), F.lit(0)).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias("lines"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    rows = rows.select(
        "doc_id", "host", "words", "n_symbols",
        F.size(words).cast("long").alias("n_words"),
        F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )
    return _repeated_words(rows).select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated_words(rows: DataFrame) -> DataFrame:
    """``rows`` with n_repeat_words, from their array of words; only texts with a repeated hash have their windows sorted."""
    window = lambda at: F.slice("words", at, WINDOW)
    at = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    rows = rows.withColumn("hashes", F.when(F.size("words") > WINDOW, F.transform(at, lambda i: F.xxhash64(window(i)))))
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("at"))))
    rows = rows.withColumn("placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed))

    def same(i: Column, j: Column) -> Column:
        a, b = F.get("placed", i), F.get("placed", j)
        return F.coalesce((a["h"] == b["h"]) & (window(a["at"]) == window(b["at"])), F.lit(False))

    twice = F.filter("placed", lambda w, i: same(i, i - 1) | same(i, i + 1))
    rows = rows.withColumn("twice", F.when(F.col("placed").isNotNull(), F.sort_array(F.transform(twice, lambda w: w["at"]))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda s, p: F.struct((s["n"] + WINDOW - F.greatest(F.lit(0), s["end"] - p)).alias("n"), (p + WINDOW).alias("end"))
    return rows.withColumn("n_repeat_words", F.coalesce(F.aggregate("twice", start, step, lambda s: s["n"]), F.lit(0)).cast("long"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def beta_prior(hosts: int, docs: int, failed: int, squares: float, sizes: float) -> tuple[float, float]:
    """Mean and strength (a + b) of the beta prior of a rule's host rates.

    squares: the sum over hosts of failed**2 / documents; sizes: of documents**2. The strength is at least 1 and at most the number of documents, which it is
    when hosts differ no more than by chance.
    """
    mean = failed / docs if docs else 0.0
    if hosts < 2 or docs <= hosts:
        return mean, float(max(docs, 1))
    between, within = (squares - failed * failed / docs) / (hosts - 1), (failed - squares) / (docs - hosts)
    typical = (docs - sizes / docs) / (hosts - 1)
    whole = between + (typical - 1) * within
    share = (between - within) / whole if whole > 0 else 0.0
    return mean, min(max((1 - share) / share, 1.0), float(docs)) if share > 0 else float(docs)


def host_rates(rows: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """(host, n, one shrunk failure rate per rule), from document features."""
    failed = [F.sum(F.expr(rule).cast("long")).alias(f"failed_{name}") for name, rule in rules.items()]
    hosts = written(rows.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n"), *failed), "host-counts")
    sums = [F.count("*").alias("hosts"), F.sum("n").alias("docs"), F.sum(F.col("n").cast("double") * F.col("n")).alias("sizes")]
    for name in rules:
        f = F.col(f"failed_{name}")
        sums += [F.sum(f).alias(f"failed_{name}"), F.sum(f.cast("double") * f / F.col("n")).alias(f"squares_{name}")]
    total = hosts.agg(*sums).first()
    rates = []
    for name in rules:
        mean, strength = beta_prior(total["hosts"], total["docs"] or 0, total[f"failed_{name}"] or 0, total[f"squares_{name}"] or 0.0, total["sizes"] or 0.0)
        rates.append(((F.col(f"failed_{name}") + mean * strength) / (F.col("n") + strength)).alias(f"rate_{name}"))
    return hosts.select("host", "n", *rates)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, host, its features, base_failed, host_rate (the worst of its host; null without host) and kept."""
    rows = written(features(docs, id_col, text_col, host_col), "host-features")
    worst = F.greatest(*[F.col(f"rate_{name}") for name in RULES], F.lit(0.0))
    hosts = host_rates(rows).select("host", worst.alias("host_rate"))
    out = rows.join(hosts, "host", "left").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= limit))
