"""Subscriptions kept in a table, matched by a token trie of equi-joins.

Subscriptions are rows (driver_id, source_type, pattern), as many as one likes. Their patterns become the edges of a trie: a node is the text of a
pattern's first tokens, an edge leads from a node over a token to the next. Each different subject walks the trie level by level, by one
equality join per level with its own token, ``*`` and ``>`` as the possible edges. So the work of a subject follows from the branches that it can take,
not from the number of subscriptions, and no level compares subjects with patterns by a condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.maps import text_map

_ROOT = ""


def trie_edges(patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(level, parent, token, child, pattern): the edges of all patterns; ``pattern`` where one ends.

    A ``>`` that is not the last token is an error.
    """
    tokens = F.split("__p", r"\.")
    bad = F.exists(F.slice(tokens, 1, F.size(tokens) - 1), lambda t: t == ">")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("'>' may only end a subscription: "), F.col("__p")))).otherwise(tokens)
    one = patterns.select(F.col(pattern).alias("__p")).filter(F.col("__p").isNotNull()).distinct().withColumn("__t", checked)
    steps = one.select("__p", "__t", F.posexplode("__t").alias("level", "token"))
    head = lambda n: F.array_join(F.slice("__t", F.lit(1), n), ".")
    return steps.select(
        "level", F.when(F.col("level") == 0, F.lit(_ROOT)).otherwise(head(F.col("level"))).alias("parent"), "token",
        head(F.col("level") + 1).alias("child"), F.when(F.col("level") == F.size("__t") - 1, F.col("__p")).alias("pattern"),
    ).groupBy("level", "parent", "token", "child").agg(F.max("pattern").alias("pattern"))


def match_subjects(subjects: DataFrame, patterns: DataFrame, subject: str = "subject", pattern: str = "pattern") -> DataFrame:
    """(subject, pattern) of every different subject and every pattern that it matches: ``*`` is one token, a trailing ``>`` one or more."""
    edges = trie_edges(patterns, pattern)
    depth = edges.agg(F.max("level")).first()[0]
    walk = subjects.select(F.col(subject).alias("subject")).filter(F.col("subject").isNotNull()).distinct()
    walk = walk.select("subject", F.split("subject", r"\.").alias("tokens"), F.lit(_ROOT).alias("node"))
    out = walk.select("subject", F.lit(None).cast("string").alias("pattern")).limit(0)
    for level in range(0 if depth is None else depth + 1):
        own = F.get("tokens", F.lit(level))
        # an empty token is one as well, but matches no wildcard; ">" needs one character left at least
        rest = F.array_join(F.slice("tokens", level + 1, F.size("tokens")), ".")
        wild = F.array_compact(F.array(own, F.when((own != "") & (own != "*"), F.lit("*")), F.when((rest != "") & (own != ">"), F.lit(">"))))
        here = walk.filter(F.size("tokens") > level).select("subject", "tokens", F.col("node").alias("parent"), F.explode(wild).alias("token"))
        step = here.join(edges.filter(F.col("level") == level).drop("level"), ["parent", "token"])
        ends = F.col("pattern").isNotNull() & ((F.col("token") == ">") | (F.size("tokens") == level + 1))
        out = out.unionByName(step.filter(ends).select("subject", "pattern"))
        walk = step.filter((F.col("token") != ">") & (F.size("tokens") > level + 1)).select("subject", "tokens", F.col("child").alias("node"))
    return out.distinct()


def route_by_table(df: DataFrame, subscriptions: DataFrame, per_pattern: bool = False, skip_origin: bool = False) -> DataFrame:
    """One row per command and target it is for, like ``route_commands``; adds ``driver_id`` and ``source_type``.

    subscriptions: driver_id, source_type, pattern, and optionally enabled and writable. A target may subscribe any number of times; a command
    reaches it once, or with ``per_pattern`` once per matching pattern.
    """
    for flag in ("enabled", "writable"):
        if flag in subscriptions.columns:
            subscriptions = subscriptions.filter(F.col(flag))
    matched = match_subjects(df, subscriptions)
    targets = subscriptions.select("driver_id", "source_type", "pattern").distinct()
    found = matched.join(targets, "pattern")
    found = found if per_pattern else found.select("subject", "driver_id", "source_type").distinct()
    side = found.select(F.col("subject").alias("__subject"), F.struct("driver_id", "source_type").alias("__to"))
    out = df.join(side, F.col("subject") == F.col("__subject"))
    meta = F.coalesce("meta", text_map({}))

    def meant_for(name: str, value: Column) -> Column:
        given = F.trim(F.coalesce(F.try_element_at(meta, F.lit(name)), F.lit("")))
        return (given == "") | (F.lower(F.try_element_at(meta, F.lit(name))) == F.lower(value))

    ok = meant_for("targetDriverId", F.col("__to.driver_id")) & meant_for("targetSourceType", F.col("__to.source_type"))
    if skip_origin:
        origin = F.lower(F.coalesce(F.try_element_at(meta, F.lit("originDriverId")), F.lit("")))
        ok = ok & (origin != F.lower("__to.driver_id"))
    keep = [c for c in df.columns if c not in ("driver_id", "source_type")]
    return out.filter(ok).select(*keep, "__to.*")
