"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changeflow.llm import alignment, decontaminate, host_rules, language, lexical, mixing, near_dedup, quality, substring_dedup, token_counts, token_files, url_lists, vector_search
from changeflow.plans.tables import read

# Lists of the URL query: kind, share of patterns that are ever listed (1 / n).
LISTS = (("malware", "url", 11), ("spam", "host", 5), ("parked", "domain", 7), ("tracking", "prefix", 9), ("trusted", "host", 13))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = quality.learn(docs, read(spark, folder, "labels"), F.pmod(F.crc32("id"), F.lit(4)) != 2)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    scored = quality.score(docs, model)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for hosts, domains, prefixes and URLs of the pages.

    A hash of list and pattern decides whether and when a pattern is added, removed 60 days later, and added again after 90 more.
    """
    keys = pages.select(F.explode(url_lists.url_keys(F.col("url"))).alias("key")).select("key.kind", "key.pattern").distinct()
    digit = lambda c: F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("int")
    parts = []
    for name, kind, share in LISTS:
        h = digit(F.concat(F.lit(name), F.col("pattern")))
        steps = F.array(*[F.struct(F.lit(action).alias("action"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(h, F.lit(250)) + days).alias("dated")) for action, days in (("add", 0), ("remove", 60), ("add", 150))])
        own = keys.where((F.col("kind") == kind) & (F.pmod(h, F.lit(share)) == 0))
        parts.append(own.select(F.lit(name).alias("list"), "kind", "pattern", F.explode(steps).alias("s")).select("list", "kind", "pattern", "s.action", "s.dated"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op2_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(400)).cast("int")).cast("timestamp"))
    out = url_lists.judge(captures, list_entries(pages), allow=["trusted"])
    return out.select("page_id", "url", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_on"), F.array_join("lists", ",").alias("lists"), "blocked")


_SQL_KEYS = r"""
parts AS (
  SELECT DISTINCT url AS u, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)(\?[^#]*)?', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)(\?[^#]*)?', 2) AS raw_path,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)(\?[^#]*)?', 3) AS query
  FROM pages WHERE url IS NOT NULL),
paths AS (SELECT u, host, CASE WHEN raw_path = '' THEN '/' ELSE raw_path END AS path, query FROM parts WHERE host <> ''),
split AS (SELECT *, string_split(host, '.') AS labels, string_split(path, '/') AS segments FROM paths),
keys AS (
  SELECT u, 'url' AS kind, host || path || query AS pattern FROM split
  UNION ALL SELECT u, 'host', host FROM split
  UNION ALL SELECT u, 'domain', array_to_string(labels[i:], '.') FROM (SELECT u, labels, unnest(range(1, len(labels))) AS i FROM split)
  UNION ALL SELECT u, 'prefix', host || array_to_string(segments[1:i], '/') || '/' FROM (SELECT u, host, segments, unnest(range(1, len(segments))) AS i FROM split))"""


def _url_sql() -> str:
    lists = " UNION ALL ".join(
        f"SELECT '{name}' AS list, kind, pattern, ('0x' || substr(md5('{name}' || pattern), 1, 4))::BIGINT AS h FROM patterns WHERE kind = '{kind}' AND ('0x' || substr(md5('{name}' || pattern), 1, 4))::BIGINT % {share} = 0"
        for name, kind, share in LISTS
    )
    return f"""WITH {_SQL_KEYS},
patterns AS (SELECT DISTINCT kind, pattern FROM keys),
listed AS ({lists}),
valid AS (
  SELECT list, kind, pattern, DATE '2024-01-01' + (h % 250)::INT AS valid_from, DATE '2024-01-01' + (h % 250 + 60)::INT AS valid_to FROM listed
  UNION ALL SELECT list, kind, pattern, DATE '2024-01-01' + (h % 250 + 150)::INT, DATE '9999-01-01' FROM listed),
captures AS (SELECT page_id, url, DATE '2024-01-01' + (((page_id * 7919) % 400 + 400) % 400)::INT AS fetched FROM pages),
hits AS (
  SELECT DISTINCT c.url, c.fetched, v.list FROM (SELECT DISTINCT url, fetched FROM captures) c JOIN keys k ON k.u = c.url
  JOIN valid v ON v.kind = k.kind AND v.pattern = k.pattern AND v.valid_from <= c.fetched AND c.fetched < v.valid_to),
lists AS (SELECT url, fetched, string_agg(list, ',' ORDER BY list) AS lists, bool_or(list = 'trusted') AS trusted FROM hits GROUP BY url, fetched)
SELECT c.page_id, c.url, strftime(c.fetched, '%Y-%m-%d') AS fetched_on, coalesce(l.lists, '') AS lists, l.lists IS NOT NULL AND NOT l.trusted AS blocked
FROM captures c LEFT JOIN lists l ON l.url = c.url AND l.fetched = c.fetched"""


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(read(spark, folder, "documents")).select("doc_id", "class_id", "class_size")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"), shortest=1)
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"), F.coalesce(F.array_max("matches.coverage"), F.lit(0.0)).alias("coverage"),
        F.array_sort("matches.item_id").alias("item_ids"),
    )


def op5_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_search.top_k(read(spark, folder, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = language.learn(docs, F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = token_files.new_path(spark)
    token_files.write_token_files(read(spark, folder, "documents"), path, "word_bpe_49k.json", end_id=1)
    return token_files.read_token_files(spark, path)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, folder, "documents")).drop("kept")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read(spark, folder, "documents"), "byte_bpe_50k.json", limit=512)


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"), k=50)


def op12_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.judge(read(spark, folder, "documents")).select("doc_id", *host_rules.FEATURES, "base_failed", "kept")


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokens(read(spark, folder, "documents"), "byte_bpe_50k.json", "piece_bpe_32k.model")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality, op2_url_lists, op3_near_dedup, op4_decontaminate, op5_vector_search, op6_language, op7_token_files, op8_substring_dedup, op9_mixing, op10_token_counts, op11_lexical_search, op12_host_rules, op13_token_alignment)
}

_SQL_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

def _host_sql() -> str:
    rules = host_rules.RULES
    failed = ", ".join(f"count(*) FILTER ({rule}) AS f_{name}" for name, rule in rules.items())
    sums = ", ".join(f"sum(f_{name}) AS f_{name}, sum(f_{name}::DOUBLE * f_{name} / n) AS s_{name}" for name in rules)
    shares = ", ".join(
        f"""((s_{name} - f_{name} * f_{name} / docs) / (hosts - 1) - (f_{name} - s_{name}) / (docs - hosts))
          / nullif((s_{name} - f_{name} * f_{name} / docs) / (hosts - 1) + ((docs - sizes / docs) / (hosts - 1) - 1) * (f_{name} - s_{name}) / (docs - hosts), 0) AS r_{name}, f_{name} / docs AS m_{name}"""
        for name in rules
    )
    strengths = ", ".join(f"CASE WHEN r_{name} > 0 THEN least(greatest((1 - r_{name}) / r_{name}, 1), docs) ELSE docs END AS k_{name}, m_{name}" for name in rules)
    worst = ", ".join(f"(h.f_{name} + m_{name} * k_{name}) / (h.n + k_{name})" for name in rules)
    return rf"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM texts)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
base AS (
  SELECT t.doc_id, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN covered c ON c.doc_id = t.doc_id),
hosts AS (SELECT source, count(*) AS n, {failed} FROM base WHERE source IS NOT NULL GROUP BY source),
total AS (SELECT count(*)::DOUBLE AS hosts, sum(n)::DOUBLE AS docs, sum(n::DOUBLE * n) AS sizes, {sums} FROM hosts),
shares AS (SELECT docs, {shares} FROM total),
prior AS (SELECT {strengths} FROM shares),
rates AS (SELECT source, greatest({worst}) AS rate FROM hosts h, prior),
judged AS (SELECT b.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, coalesce(r.rate, 0) AS rate FROM base b LEFT JOIN rates r ON r.source = b.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= {host_rules.HOST_LIMIT} AS kept FROM judged"""


ORACLE: dict[str, str] = {
    "op12_host_rules": _host_sql(),
    "op2_url_lists": _url_sql(),
    "op5_vector_search": """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
           FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
    "op11_lexical_search": rf"""
WITH split AS (SELECT doc_id, {_SQL_TERMS} AS terms FROM documents),
docs AS (SELECT row_number() OVER () AS r, doc_id, terms, len(terms) AS n FROM split WHERE len(terms) > 0),
stat AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id, sum(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN df USING (term) JOIN tf USING (term), stat GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0 QUALIFY rank <= 50""",
}
