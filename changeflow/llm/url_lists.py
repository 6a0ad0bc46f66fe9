"""URL filters by temporal list join: dated list entries become validity intervals, and every capture is judged by the entries active when it was fetched.

An entry names a list, a kind, a pattern, an action (``add`` or ``remove``) and a time. Kinds: ``url`` (host, path and query), ``prefix`` (host and path up to a
slash), ``host``, and ``domain`` (the host or any of its parents of two labels or more). An entry holds from its time until the next entry of the
same list, kind and pattern; at one time ``remove`` wins.

The as-of join has no range join: the intervals of one pattern are one row, distinct URLs meet the patterns by equality, and each capture filters the intervals of
its URL by its own time. A URL, host or domain may hold any share of the captures; the size of an interval list depends on the lists alone.
DataFrame functions only.

Defined results: a null or unreadable URL, and a null fetch time, match nothing; entries with a null part are ignored, repeated entries count
once; an empty list table leaves all captures unlisted. Repeated captures come back repeated. All columns of the captures are returned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

URL = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)(\?[^#]*)?"


def host(url: Column) -> Column:
    """Lower-case host; empty if the URL cannot be read."""
    return F.lower(F.regexp_extract(url, URL, 1))


def url_key(url: Column) -> Column:
    """Host, path and query, without scheme, user, port and fragment."""
    path = F.regexp_extract(url, URL, 2)
    return F.concat(host(url), F.when(path == "", F.lit("/")).otherwise(path), F.regexp_extract(url, URL, 3))


def url_keys(url: Column, depths: Sequence[int] | None = None) -> Column:
    """Everything of a URL that an entry may name, as array<struct<kind, pattern>>; prefixes of all depths or of the given ones (slashes in them)."""
    name, path = host(url), F.regexp_extract(url, URL, 2)
    labels, parts = F.split(name, r"\."), F.split(F.when(path == "", F.lit("/")).otherwise(path), "/")
    key = lambda kind, pattern: F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))
    domains = F.when(F.size(labels) > 1, F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: key("domain", F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    deep = F.sequence(F.lit(1), F.size(parts) - 1) if depths is None else F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda i: i < F.size(parts))
    prefixes = F.transform(deep, lambda i: key("prefix", F.concat(name, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))))
    none = F.array().cast("array<struct<kind: string, pattern: string>>")
    every = F.concat(F.array(key("url", url_key(url)), key("host", name)), F.coalesce(domains, none), F.coalesce(prefixes, none))
    return F.when(name != "", every).otherwise(none)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, action, dated) to one row per interval: list, kind, pattern, valid_from, valid_to (null: still valid)."""
    clean = entries.select("list", "kind", "pattern", "action", F.col("dated").cast("timestamp").alias("dated")).dropna().distinct()
    per_time = clean.groupBy("list", "kind", "pattern", "dated").agg(F.max("action").alias("action"))  # "remove" > "add"
    following = F.lead("dated").over(Window.partitionBy("list", "kind", "pattern").orderBy("dated"))
    return per_time.withColumn("valid_to", following).where(F.col("action") == "add").select("list", "kind", "pattern", F.col("dated").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at", allow: Sequence[str] = (), lists_col: str = "lists", blocked_col: str = "blocked") -> DataFrame:
    """All rows and columns of ``captures`` with the active lists (sorted) and whether the capture is blocked: some active list, and none of ``allow``."""
    names = [f"c{i}" for i in range(len(captures.columns))]
    rows = captures.toDF(*names)
    url, fetched = names[captures.columns.index(url_col)], names[captures.columns.index(time_col)]
    listed = intervals(entries).groupBy("kind", "pattern").agg(F.collect_list(F.struct("list", "valid_from", "valid_to")).alias("entries"))
    # a URL gives only the prefixes of depths that some entry has: as many texts as the lists ask for, not one per slash
    depth = (F.size(F.split("pattern", "/")) - 1).alias("depth")
    depths = sorted(r.depth for r in entries.where((F.col("kind") == "prefix") & F.col("pattern").isNotNull()).select(depth).distinct().collect())
    keys = rows.select(F.col(url).alias("u")).where(F.col("u").isNotNull()).distinct().select("u", F.explode(url_keys(F.col("u"), depths)).alias("key"))
    hits = keys.select("u", "key.kind", "key.pattern").join(listed, ["kind", "pattern"]).groupBy("u").agg(F.flatten(F.collect_list("entries")).alias("entries"))
    at = F.col(fetched).cast("timestamp")
    active = F.filter("entries", lambda e: (e.valid_from <= at) & (e.valid_to.isNull() | (at < e.valid_to)))
    found = F.coalesce(F.array_sort(F.array_distinct(F.transform(active, lambda e: e["list"]))), F.array().cast("array<string>"))
    out = rows.join(hits, F.col(url) == F.col("u"), "left").withColumn("__lists", F.when(at.isNull(), F.array().cast("array<string>")).otherwise(found))
    allowed = F.array(*[F.lit(a) for a in allow]).cast("array<string>")
    blocked = (F.size("__lists") > 0) & ~F.arrays_overlap("__lists", allowed)
    kept = [(n, c) for n, c in zip(names, captures.columns, strict=True) if c.lower() not in (lists_col.lower(), blocked_col.lower())]
    return out.select(*(n for n, _ in kept), "__lists", blocked.alias("__blocked")).toDF(*(c for _, c in kept), lists_col, blocked_col)
