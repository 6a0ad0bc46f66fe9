"""Change-state operators: before images, change kinds, current state, identity, duplicates.

The raw change table has columns ``entity, change_type, source_ts, row STRUCT, prev STRUCT, meta``.
Keys name fields of ``row``; ``order`` names columns that order the changes of a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.lookup import lookup
from changeflow.operators.ordered import Step, measured, numbered, running, running_steps
from changeflow.scratch import shared_path

_SEEN = "__seen"
# Runs of at most this many distinct times are folded in one row.
FOLD_ROWS = 10_000


def with_history(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    keyless: bool = False,
    hot_rows: int | None = None,
    ttl: timedelta | None = None,
) -> DataFrame:
    """Before image and resolved change kind, in one ordered pass per (entity, key).

    The before image is the row of the preceding change unless that was a Delete; a supplied before
    image wins. ``Snapshot`` becomes Update when the key was seen and not since deleted, else Insert.
    With ``ttl`` a preceding change more than that before a change is forgotten.
    """
    if not key and not keyless:
        raise ValueError("no key columns: all rows would share one slot; pass keyless=True to allow it")
    group = ["entity", *[F.col(f"row.`{k}`") for k in key]]
    before_row = {"__row": "row", "__kind": "change_type"} | ({"__at": "source_ts"} if ttl is not None else {})
    out = running(df, group, order, previous=before_row, hot_rows=hot_rows)
    known = F.col("__kind") != "Delete"
    if ttl is not None:
        known = known & (F.col("source_ts") - F.col("__at") <= F.lit(ttl))
    before = F.when(known, F.col("__row"))
    supplied = F.col("prev") if "prev" in df.columns else F.lit(None)
    if "prev" in df.columns and isinstance(df.schema["prev"].dataType, T.MapType):
        supplied = F.when(F.size("prev") > 0, F.col("prev"))  # an empty image is none
    return out.withColumns(
        {
            "prev": F.coalesce(supplied, before),
            "change_type": F.when(
                F.col("change_type") == "Snapshot", F.when(known, "Update").otherwise("Insert")
            ).otherwise(F.col("change_type")),
        }
    ).drop(*before_row)


def with_before_image(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], **options) -> DataFrame:
    """Only the before image; change kinds stay as they are."""
    kept = df.withColumn("__given", F.col("change_type"))
    return with_history(kept, key, order, **options).withColumn("change_type", F.col("__given")).drop("__given")


def resolve_change_type(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], **options) -> DataFrame:
    """Only the resolved change kind; the before image stays as supplied."""
    kept = df.withColumn("__prev", F.col("prev") if "prev" in df.columns else F.lit(None).cast("string"))
    out = with_history(kept, key, order, **options)
    out = out.withColumn("prev", F.col("__prev")) if "prev" in df.columns else out.drop("prev")
    return out.drop("__prev")


def resolve_against(df: DataFrame, seen: DataFrame, key: Sequence[str]) -> DataFrame:
    """Snapshot is Update when its key is in a stored key table, else Insert."""
    flag = seen.select(*[F.col(k).alias(f"__s{k}") for k in key]).distinct().withColumn(_SEEN, F.lit(True))
    kind = F.when(F.col(_SEEN), "Update").otherwise("Insert")
    return (
        lookup(df, flag, [F.col(f"row.`{k}`") for k in key], [f"__s{k}" for k in key], null_safe=True)
        .withColumn("change_type", F.when(F.col("change_type") == "Snapshot", kind).otherwise(F.col("change_type")))
        .drop(_SEEN, *[f"__s{k}" for k in key])
    )


def current_state(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The latest row per (entity, key); deleted keys are absent.

    Spark keeps only the first row per key of each task before the shuffle (a window group limit),
    so a key with very many changes is reduced early.
    """
    newest = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    window = Window.partitionBy("entity", *[F.col(f"row.`{k}`") for k in key]).orderBy(*newest)
    return (
        df.withColumn("__n", F.row_number().over(window))
        .filter((F.col("__n") == 1) & (F.col("change_type") != "Delete"))
        .select("entity", "row")
    )


def with_sequence(
    df: DataFrame, order: Sequence[str | Column], driver: str = "driver_id", hot_rows: int | None = None
) -> DataFrame:
    """Sequence number per driver from 1. A driver usually is one huge group, see ``ordered``."""
    return numbered(df, [driver], order, "seq", hot_rows)


def with_event_id(df: DataFrame, parts: Sequence[str | Column], ts: str = "source_ts") -> DataFrame:
    """A sortable id that is the same on every run: time in hex, then the whole SHA-256 of the given parts.

    Each part is written with its length, and a missing part with none, so different parts never give the same text.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    cols = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    dtype = df.schema[ts].dataType
    stamp = F.col(ts).cast("timestamp") if isinstance(dtype, T.TimestampNTZType) else F.col(ts)
    millis = F.lpad(F.lower(F.hex(F.coalesce(F.unix_millis(stamp), F.lit(0)))), 12, "0")
    return df.withColumn("event_id", F.concat(millis, F.sha2(F.concat(*cols), 256)))


def field_diff(df: DataFrame, new: str = "row", old: str = "prev") -> DataFrame:
    """``changed`` lists {name, old, new} of fields that differ, ``unchanged`` the names that do not.

    Without a before image both lists are empty.
    """
    names = [f.name for f in df.schema[new].dataType.fields]
    before = {f.name.lower() for f in df.schema[old].dataType.fields}
    pairs = [
        (n, F.col(f"{old}.`{n}`") if n.lower() in before else F.lit(None), F.col(f"{new}.`{n}`")) for n in names
    ]
    changed = F.array_compact(
        F.array(
            *[
                F.when(
                    ~a.eqNullSafe(b),
                    F.struct(F.lit(n).alias("name"), a.cast("string").alias("old"), b.cast("string").alias("new")),
                )
                for n, a, b in pairs
            ]
        )
    )
    unchanged = F.array_compact(F.array(*[F.when(a.eqNullSafe(b), F.lit(n)) for n, a, b in pairs]))
    known = F.col(old).isNotNull()
    return df.withColumns(
        {
            "changed": F.when(known, changed).otherwise(F.slice(changed, 1, 0)),
            "unchanged": F.when(known, unchanged).otherwise(F.slice(unchanged, 1, 0)),
        }
    )


def document_paths(df: DataFrame, value: str, depth: int = 8) -> DataFrame:
    """One row per leaf of a VARIANT column: ``path`` (names joined by dots, a dot in a name as ``\\.``) and ``value``, beside all other columns.

    Arrays, empty objects and objects below ``depth`` levels are leaves. A NULL document has no rows.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c != value]
    rows = df.filter(F.col(value).isNotNull()).select(*kept, F.lit(None).cast("string").alias("path"), F.col(value).alias("value"))
    for _ in range(depth):
        # an object gives its entries, anything else stays as it is
        inner = F.when(F.schema_of_variant("value").startswith("OBJECT<") & (F.schema_of_variant("value") != "OBJECT<>"), F.col("value"))
        rows = rows.withColumn("__inner", inner)
        entries = spark.tvf.variant_explode_outer(F.col("__inner").outer()).toDF("__pos", "__name", "__value")
        name = F.replace("__name", F.lit("."), F.lit("\\."))
        rows = rows.lateralJoin(entries).select(
            *kept, F.when(F.col("__name").isNull(), F.col("path")).otherwise(F.concat_ws(".", "path", name)).alias("path"),
            F.when(F.col("__name").isNull(), F.col("value")).otherwise(F.col("__value")).alias("value"),
        )
    return rows


def document_diff(df: DataFrame, key: Sequence[str], new: str, old: str, depth: int = 8) -> DataFrame:
    """Paths of two versions of a document that differ: (key columns, path, kind, old, new), values as JSON text.

    ``new`` and ``old`` are JSON text or VARIANT; each document has its own fields. ``kind`` is added, removed or changed. Without a
    before image, or without a document, nothing is reported; text that is no JSON counts as none. Both versions are taken apart in one pass.
    """
    parsed = {c: F.try_parse_json(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c) for c in (new, old)}
    both = df.select(*key, parsed[new].alias("n"), parsed[old].alias("o")).filter("n is not null and o is not null")
    sides = both.select(*key, F.explode(F.array(F.struct(F.lit(True).alias("new"), F.col("n").alias("v")), F.struct(F.lit(False).alias("new"), F.col("o").alias("v")))).alias("__s"))
    leaves = document_paths(sides.select(*key, "__s.new", "__s.v"), "v", depth).withColumn("text", F.to_json("value"))
    found = leaves.groupBy(*key, "path").agg(
        F.max(F.when(~F.col("new"), F.coalesce("text", F.lit("null")))).alias("old"), F.max(F.when(F.col("new"), F.coalesce("text", F.lit("null")))).alias("new")
    )
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return found.withColumn("kind", kind).filter("kind is not null").select(*key, "path", "kind", "old", "new")


def key_history(df: DataFrame, key_values: Mapping[str, object], order: Sequence[str], pk: str = "row") -> DataFrame:
    """All changes whose key holds the given values, newest first."""
    for name, value in key_values.items():
        df = df.filter(F.col(f"{pk}.`{name}`") == F.lit(value))
    return df.orderBy(*[F.col(c).desc() for c in order])


def dedup_requests(
    df: DataFrame,
    request: str,
    ts: str,
    ttl: timedelta = timedelta(minutes=5),
    tie: Sequence[str] = (),
    hot_rows: int | None = None,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """Add ``duplicate``: true within ``ttl`` after the last *accepted* row of the same request id.

    A row is accepted when no accepted row of its id lies less than ``ttl`` before it; duplicates do
    not extend the window. A run of rows without a gap of ``ttl`` starts with an accepted row, and a
    run shorter than ``ttl`` accepts nothing else, so most ids need one ordered pass. Longer runs of
    up to ``fold_rows`` times are folded in order. Still longer ones are followed by doubling: each
    time points to the first one at least ``ttl`` later, and those reached from the start of a run
    are found in a number of joins that grows with the logarithm of the longest run, so one very
    busy id stays parallel.
    """
    spark = df.sparkSession
    micros = int(ttl.total_seconds() * 1_000_000)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.withColumn("__at", at)

    # One row per distinct (id, time): only the first of equal times can be accepted.
    times = rows.groupBy(F.col(request).alias("__id"), "__at").agg(F.count(F.lit(1)).alias("__rows"))
    hot = measured(df, [request], hot_rows)
    head = F.col("__before").isNull() | (F.col("__at") - F.col("__before") >= micros)
    steps = [
        Step(previous={"__before": "__at"}, derive={"__head": head}),
        Step(
            last={"__start": F.when(F.col("__head"), F.col("__at"))},
            derive={"__run": F.when(F.col("__head"), F.col("__at")).otherwise(F.col("__start"))},
        ),
    ]
    times = running_steps(times, ["__id"], ["__at"], steps, hot_rows=hot).select("__id", "__at", "__head", "__run")
    path = shared_path(spark, "dedup")
    times.write.parquet(f"{path}/times")
    times = spark.read.parquet(f"{path}/times")

    accepted = times.filter("__head").select("__id", "__at")
    runs = times.groupBy("__id", "__run").agg(F.max("__at").alias("__end"), F.count(F.lit(1)).alias("__size"))
    runs = runs.filter(F.col("__end") - F.col("__run") >= micros)
    short = _of_runs(times, runs.filter(F.col("__size") <= fold_rows))
    accepted = accepted.unionByName(_folded(short, micros))
    span = runs.filter(F.col("__size") > fold_rows).agg(F.max(F.col("__end") - F.col("__run"))).first()[0]
    if span is not None:
        busy = _of_runs(times, runs.filter(F.col("__size") > fold_rows))
        busy.write.parquet(f"{path}/busy")
        busy = spark.read.parquet(f"{path}/busy")
        accepted = accepted.unionByName(_reached(busy, micros, span, path, hot_rows))

    # The first row of an accepted (id, time) is the accepted one.
    firsts = accepted.select(F.col("__id").alias("__fid"), F.col("__at").alias("__fat"), F.lit(True).alias("__ok"))
    marked = numbered(rows, [request, "__at"], list(tie) or ["__at"], "__n", hot_rows)
    out = lookup(marked, firsts, [request, "__at"], ["__fid", "__fat"], null_safe=True)
    return out.withColumn("duplicate", F.col("__ok").isNull() | (F.col("__n") > 1)).select(*df.columns, "duplicate")


def _of_runs(times: DataFrame, runs: DataFrame) -> DataFrame:
    """The times of some runs; a NULL request id is an id like any other."""
    wanted = runs.select(F.col("__id").alias("__rid"), F.col("__run").alias("__rrun"))
    return times.join(wanted, F.col("__id").eqNullSafe(F.col("__rid")) & (F.col("__run") == F.col("__rrun")), "left_semi")


def _same_id(left: DataFrame, right: DataFrame, time: str, how: str = "inner") -> DataFrame:
    """Join on ("__id", time), NULL ids included."""
    other = right.withColumnsRenamed({"__id": "__oid", time: "__otime"})
    return left.join(other, F.col("__id").eqNullSafe(F.col("__oid")) & (F.col(time) == F.col("__otime")), how)


def _folded(runs: DataFrame, micros: int) -> DataFrame:
    """Accepted times after the head of runs that are short enough to be one row each."""
    ats = F.sort_array(F.collect_list("__at"))
    keep = F.aggregate(
        F.col("__ats"),
        F.array(F.col("__run")),
        lambda kept, at: F.when(at - F.element_at(kept, -1) >= micros, F.array_append(kept, at)).otherwise(kept),
    )
    return (
        runs.groupBy("__id", "__run").agg(ats.alias("__ats"))
        .select("__id", F.explode(F.slice(keep, 2, F.size(keep))).alias("__at"))
    )


def _reached(busy: DataFrame, micros: int, span: int, path: str, hot_rows: int | None) -> DataFrame:
    """Accepted times after the head of each long run, by pointer doubling."""
    spark = busy.sparkSession
    # next = first time of the run at least ttl later: look backwards over times and shifted probes.
    points = busy.select("__id", "__run", "__at", F.lit(0).alias("__probe"), F.col("__at").alias("__from"))
    probes = busy.select(
        "__id", "__run", (F.col("__at") + micros).alias("__at"), F.lit(1).alias("__probe"), F.col("__at").alias("__from")
    )
    line = running(
        points.unionByName(probes).withColumns({"__b": -F.col("__at"), "__t": F.col("__probe")}),
        ["__id", "__run"], ["__b", "__t"],
        last={"__next": F.when(F.col("__probe") == 0, F.col("__at"))}, hot_rows=hot_rows,
    )
    jump = line.filter("__probe = 1 and __next is not null").select("__id", F.col("__from").alias("__at"), "__next")
    levels = max(1, (span // micros).bit_length())
    jumps = []
    for level in range(levels):
        jump.write.parquet(f"{path}/jump-{level}")
        jump = spark.read.parquet(f"{path}/jump-{level}")
        jumps.append(jump)
        step = jump.select("__id", F.col("__at").alias("__next"), F.col("__next").alias("__far"))
        jump = _same_id(jump, step, "__next").select("__id", "__at", F.col("__far").alias("__next"))
    reached = busy.filter("__head").select("__id", "__at")
    for level in reversed(range(levels)):
        far = _same_id(reached, jumps[level], "__at").select("__id", F.col("__next").alias("__at"))
        reached = reached.unionByName(far)
        reached.write.parquet(f"{path}/reached-{level}")
        reached = spark.read.parquet(f"{path}/reached-{level}")
    return _same_id(reached, busy.filter("__head").select("__id", "__at"), "__at", "left_anti")
