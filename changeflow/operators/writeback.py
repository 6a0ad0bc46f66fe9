"""Write commands: decoding, routing, applying them to tables, echo suppression."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.maps import merge_ignoring_case, override, text_map
from changeflow.functions.text import subject_matches
from changeflow.operators.lookup import lookup
from changeflow.operators.ordered import Hot, Step, measured, running_steps
from changeflow.operators.renames import components, fold_components
from changeflow.scratch import shared_path
from changeflow.spec import Target

# Change kinds (lower case) and the write operation they mean.
OPERATIONS = {"insert": "Create", "create": "Create", "update": "Update", "snapshot": "Update", "delete": "Delete"}
# Command fields, the point attributes they set, and the defaults on create.
POINT_ATTRIBUTES = {
    "descriptor": "descriptor", "engineeringUnits": "engunits", "pointType": "pointtype", "pointClass": "pointclass",
}
POINT_DEFAULTS = {"pointType": "Float32", "pointClass": "classic"}
# Commands of one component of keys that one task works off in order.
FOLD_COMMANDS = 5_000_000


def decode_commands(df: DataFrame) -> DataFrame:
    """Envelopes as write commands.

    Input: event_id, entity, change_type, pk, fields, meta (MAP<STRING,STRING>). The entity path is
    cut at its first slash into type and name; the name fills a missing key ``name``. Other change
    kinds are dropped.
    """
    operation = F.lit(None).cast("string")
    for kind, op in OPERATIONS.items():
        operation = F.when(F.lower("change_type") == kind, F.lit(op)).otherwise(operation)
    slash = F.instr("entity", "/")
    kind = F.when(slash > 1, F.substring_index("entity", "/", 1)).otherwise(F.col("entity"))
    name = F.when(slash > 1, F.expr("substring(entity, instr(entity, '/') + 1)")).otherwise(F.col("entity"))
    pk = F.coalesce("pk", text_map({}))
    return (
        df.withColumns({"operation": operation, "entity_type": kind, "__name": name})
        .filter(F.col("operation").isNotNull())
        .withColumns(
            {
                "pk": F.when(F.map_contains_key(pk, "name"), pk).otherwise(
                    F.map_concat(pk, F.create_map(F.lit("name"), F.col("__name")))
                ),
                "correlation_id": F.col("event_id"),
            }
        )
        .drop("__name")
    )


def route_commands(
    df: DataFrame, targets: Sequence[Target], per_pattern: bool = False, skip_origin: bool = False
) -> DataFrame:
    """One row per command and target it is for; adds ``driver_id`` and ``source_type``.

    A target gets a command when one of its subscriptions matches the subject and neither
    ``targetDriverId`` nor ``targetSourceType`` names another. The targets are settings, so the
    routing is an expression per row and needs no join. ``per_pattern`` delivers once per matching
    subscription; ``skip_origin`` leaves out the target a command came from.
    """
    meta = F.coalesce("meta", text_map({}))

    def meant_for(name: str, value: str) -> Column:
        given = F.trim(F.coalesce(F.try_element_at(meta, F.lit(name)), F.lit("")))
        return (given == "") | (F.lower(F.try_element_at(meta, F.lit(name))) == value.lower())

    copies = []
    for t in targets:
        if not (t.enabled and t.writable):
            continue
        ok = meant_for("targetDriverId", t.driver) & meant_for("targetSourceType", t.source_type)
        if skip_origin:
            origin = F.lower(F.coalesce(F.try_element_at(meta, F.lit("originDriverId")), F.lit("")))
            ok = ok & (origin != t.driver.lower())
        where = F.struct(F.lit(t.driver).alias("driver_id"), F.lit(t.source_type).alias("source_type"))
        hits = [subject_matches("subject", p) for p in t.subjects]
        if not per_pattern and hits:
            any_hit = hits[0]
            for h in hits[1:]:
                any_hit = any_hit | h
            hits = [any_hit]
        copies += [F.when(ok & h, where) for h in hits]
    if not copies:
        return df.limit(0).withColumns({"driver_id": F.lit(None).cast("string"), "source_type": F.lit(None).cast("string")})
    keep = [c for c in df.columns if c not in ("driver_id", "source_type")]
    return df.withColumn("__to", F.explode(F.array_compact(F.array(*copies)))).select(*keep, "__to.*")


def resolve_target(df: DataFrame) -> DataFrame:
    """Add ``name``, ``target`` and ``error`` of attribute commands.

    The target is the key's ``elementPath``, else its ``elementName``, else the field ``element``;
    the name is the key's, else the field's. Empty text counts as missing.
    """
    get = lambda m, k: F.nullif(F.try_element_at(F.col(m), F.lit(k)), F.lit(""))
    name = F.coalesce(get("pk", "name"), get("fields", "name"))
    target = F.coalesce(get("pk", "elementPath"), get("pk", "elementName"), get("fields", "element"))
    error = F.when(name.isNull(), "command has no name").when(target.isNull(), "target element not found")
    return df.withColumns({"name": name, "target": target, "error": error})


def plan_commands(
    table: DataFrame,
    cmds: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    types: Sequence[str] | None = None,
    hot_rows: Hot = None,
) -> DataFrame:
    """Commands with ``success``, ``message`` and ``segment``, as if they were applied one by one in order.

    cmds: correlation_id, operation, the key and value columns of the table, and optionally ``set``
    (names of the columns a command supplies; without it those that are not NULL), ``entity_type``
    and ``error`` (a command that cannot be carried out). Whether a key exists before a command is
    decided by the last Create or Delete before it, else by the table. Successful Creates and Deletes
    begin a new segment of the key's commands.
    """
    here = table.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(key)], F.lit(True).alias("__stored"))
    stored = [f"__t{i}" for i in range(len(key))]
    hot_rows = measured(cmds, list(key), hot_rows)
    joined = lookup(cmds, here, list(key), stored).drop(*stored)
    fault = F.col("error") if "error" in cmds.columns else F.lit(None).cast("string")
    if types is not None and "entity_type" in cmds.columns:
        unsupported = F.when(
            ~F.lower("entity_type").isin(*[t.lower() for t in types]),
            F.concat(F.lit("unsupported entity type "), F.col("entity_type")),
        )
        fault = F.coalesce(fault, unsupported)
    joined = joined.withColumn("__fault", fault)
    valid, op = F.col("__fault").isNull(), F.col("operation")
    leaves = F.when(valid & (op == "Create"), F.lit(True)).when(valid & (op == "Delete"), F.lit(False))
    exists = F.coalesce("__left", "__stored", F.lit(False))
    message = (
        F.when(~valid, F.col("__fault"))
        .when((op == "Create") & exists, "already exists")
        .when((op == "Update") & ~exists, "not found")
        .when(~op.isin("Create", "Update", "Delete"), F.concat(F.lit("unknown operation "), op))
    )
    reset = (F.col("success") & op.isin("Create", "Delete")).cast("int")
    steps = [
        Step(last={"__left": leaves}, derive={"message": message, "success": message.isNull()}),
        Step(total={"__resets": reset}, derive={"segment": F.col("__resets") + reset}),
    ]
    return running_steps(joined, key, order, steps, hot_rows).drop("__fault", "__left", "__stored", "__resets")


def command_results(planned: DataFrame, key: Sequence[str]) -> DataFrame:
    """One result row per command."""
    return planned.select("correlation_id", "operation", *key, "success", F.col("message").alias("error_message"))


def apply_planned(table: DataFrame, planned: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table after the successful commands.

    An Update sets only the supplied columns; a Create after a Delete starts empty, so only the last
    segment of a key counts. The commands are reduced to one row per key by a partial aggregate
    before they meet the table.
    """
    values = [c for c in table.columns if c not in key]
    done = planned.filter("success").withColumnRenamed("segment", "__seg")
    reset = F.col("operation").isin("Create", "Delete")
    rank = F.struct("__seg", *order)

    def given(c: str) -> Column:
        named = F.array_contains("set", c) if "set" in planned.columns else F.col(c).isNotNull()
        return (F.col("operation") != "Delete") & named

    last = [
        F.max_by(F.struct("__seg", F.col(c).alias("v")), F.when(given(c), rank)).alias(f"__v{i}")
        for i, c in enumerate(values)
    ]
    touched = done.groupBy(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(key)]).agg(
        F.max("__seg").alias("__last"),
        F.max_by(F.col("operation"), F.when(reset, rank)).alias("__reset"),
        F.lit(True).alias("__touched"),
        *last,
    )
    on = [F.col(k) == F.col(f"__c{i}") for i, k in enumerate(key)]
    both = table.withColumn("__stored", F.lit(True)).join(touched, on, "full")
    alive = F.coalesce(F.col("__reset") == "Create", F.col("__stored"), F.lit(False))

    def value(i: int, c: str) -> Column:
        new = F.col(f"__v{i}")
        in_last = new["__seg"] == F.col("__last")
        base = F.when(F.col("__last") > 0, F.lit(None)).otherwise(F.col(c))
        return F.when(F.col("__touched").isNull(), F.col(c)).when(in_last, new["v"]).otherwise(base)

    kept = both.filter(alive)
    return kept.select(
        *[F.coalesce(F.col(k), F.col(f"__c{i}")).alias(k) for i, k in enumerate(key)],
        *[value(i, c).alias(c) for i, c in enumerate(values)],
    ).select(*table.columns)


def apply_commands(
    table: DataFrame,
    cmds: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    types: Sequence[str] | None = None,
    hot_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The table after the commands, and one result row per command."""
    planned = plan_commands(table, cmds, key, order, types, hot_rows)
    return apply_planned(table, planned, key, order), command_results(planned, key)


def rename_target(fields: str, current: str | Column) -> Column:
    """The new name an update asks for: ``newName``, else ``name``, when not empty and different."""
    current = F.col(current) if isinstance(current, str) else current
    wanted = [F.nullif(F.try_element_at(F.col(fields), F.lit(n)), F.lit("")) for n in ("newName", "name")]
    return F.coalesce(*[F.when(w != current, w) for w in wanted])


def apply_with_renames(
    table: DataFrame, cmds: DataFrame, key: str, order: Sequence[str], new_key: str = "new_key", hot_rows: int | None = None,
    most: int = FOLD_COMMANDS,
) -> tuple[DataFrame, DataFrame]:
    """``apply_commands`` where an Update may also change the key of its row.

    Later commands address the new key, so a rename must be decided before what follows it on either key. Keys that renames connect form components.
    The commands of each component run in order in one pass over it, those on all other keys as one set. A component of more than ``most`` commands,
    which would be too much for one task, is worked off in rounds instead. A rename fails as a whole when its row is missing or the new key is taken.
    """
    spark, path = table.sparkSession, shared_path(table.sparkSession, "renames")
    rename = (F.col("operation") == "Update") & F.col(new_key).isNotNull() & (F.col(new_key) != F.col(key))
    cmds = _kept(cmds, f"{path}/commands")
    label = components(cmds.filter(rename), key, new_key).select(F.col("node").alias("__node"), "component")
    marked = lookup(cmds, label, [key], ["__node"]).drop("__node")
    large = marked.filter("component is not null").groupBy("component").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most).select("component")
    large = _kept(large, f"{path}/large")
    own = label.join(table.select(F.col(key).alias("__node")).distinct(), "__node", "left_semi")
    rows = table.join(own, F.col(key) == F.col("__node")).drop("__node")
    after, results = fold_components(
        rows.join(large, "component", "left_anti").select("component", *table.columns),
        marked.filter("component is not null").join(large, "component", "left_anti"), key, new_key, order,
    )
    plain, planned = apply_commands(
        table.join(label, F.col(key) == F.col("__node"), "left_anti"), marked.filter("component is null").drop("component"), [key], order, hot_rows=hot_rows
    )
    out = plain.unionByName(after)
    results = results.unionByName(planned.withColumn(new_key, F.lit(None).cast(cmds.schema[new_key].dataType)).select(*results.columns))
    if not large.isEmpty():
        many = rows.join(large, "component", "left_semi").select(*table.columns)
        rounds, more = _in_rounds(many, marked.join(large, "component", "left_semi").select(*cmds.columns), key, order, new_key, hot_rows)
        out, results = out.unionByName(rounds), results.unionByName(more.select(*results.columns))
    return out, results


def _in_rounds(
    table: DataFrame, cmds: DataFrame, key: str, order: Sequence[str], new_key: str, hot_rows: int | None
) -> tuple[DataFrame, DataFrame]:
    """``apply_with_renames`` for components too large for one task.

    The batch is worked off in rounds: a round takes all commands that precede the first open
    rename of their key, then every rename that is the first open one of both its keys. Rounds are as
    many as the longest chain of renames that touch a common key; each runs on all keys at once.
    A rename fails as a whole when its row is missing or the new key is taken.
    """
    spark = table.sparkSession
    path = shared_path(spark, "renames")
    rank = F.struct(*order)
    values = [c for c in table.columns if c != key]
    rename = (F.col("operation") == "Update") & F.col(new_key).isNotNull() & (F.col(new_key) != F.col(key))
    pending = cmds.withColumns({"__rank": rank, "__rename": F.coalesce(rename, F.lit(False))})
    pending = _kept(pending, f"{path}/pending-0")
    named = pending.select(key).unionByName(pending.filter("__rename").select(F.col(new_key).alias(key))).distinct()
    work = _kept(table.join(named, key, "left_semi"), f"{path}/table-0")
    results = None
    for step in itertools.count(1):
        open_renames = pending.filter("__rename")
        mentions = open_renames.select(F.col(key).alias("__k"), "__rank").unionByName(
            open_renames.select(F.col(new_key).alias("__k"), "__rank")
        )
        first = mentions.groupBy("__k").agg(F.min("__rank").alias("__first"))
        marked = lookup(pending, first, [key], ["__k"]).drop("__k")
        target = first.select(F.col("__k").alias("__nk"), F.col("__first").alias("__nfirst"))
        wanted = F.when(F.col("__rename"), F.col(new_key))
        marked = lookup(marked, target, [wanted], ["__nk"]).drop("__nk")
        free = ~F.col("__rename") & (F.col("__first").isNull() | (F.col("__rank") < F.col("__first")))
        turn = F.col("__rename") & (F.col("__rank") == F.col("__first")) & (F.col("__rank") == F.col("__nfirst"))
        marked = _kept(marked.withColumns({"__free": free, "__turn": turn}), f"{path}/marked-{step}")

        planned = plan_commands(work, marked.filter("__free"), [key], order, hot_rows=hot_rows)
        planned = _kept(planned, f"{path}/planned-{step}")
        work = _kept(apply_planned(work, planned, [key], order), f"{path}/applied-{step}")
        moves = _kept(_moves(work, marked.filter("__turn"), key, new_key, values), f"{path}/moves-{step}")
        done = moves.filter("success")
        work = work.join(done.select(key), key, "left_anti").unionByName(
            done.select(F.col(new_key).alias(key), *[F.col(f"__new.`{c}`").alias(c) for c in values])
        )
        work = _kept(work, f"{path}/table-{step}")
        for part in (planned.withColumn(new_key, F.lit(None).cast(cmds.schema[new_key].dataType)), moves):
            part = part.select("correlation_id", "operation", key, new_key, "success", F.col("message").alias("error_message"))
            results = part if results is None else results.unionByName(part)
        rest = marked.filter("not __free and not __turn").drop("__first", "__nfirst", "__free", "__turn")
        pending = _kept(rest, f"{path}/pending-{step}")
        if pending.isEmpty():
            break
    return table.join(named, key, "left_anti").unionByName(work), results


def _moves(work: DataFrame, renames: DataFrame, key: str, new_key: str, values: Sequence[str]) -> DataFrame:
    """Renames with ``success``, ``message`` and the row as it will be under the new key."""
    old = work.select(F.col(key).alias("__ok"), F.struct(*values).alias("__old"))
    taken = work.select(F.col(key).alias("__tk"), F.lit(True).alias("__taken"))
    out = renames.join(old, F.col(key) == F.col("__ok"), "left").join(taken, F.col(new_key) == F.col("__tk"), "left")

    def value(c: str) -> Column:
        named = F.array_contains("set", c) if "set" in renames.columns else F.col(c).isNotNull()
        return F.when(named, F.col(c)).otherwise(F.col(f"__old.`{c}`"))

    fault = F.col("error") if "error" in renames.columns else F.lit(None).cast("string")
    message = (
        F.when(fault.isNotNull(), fault).when(F.col("__old").isNull(), "not found").when(F.col("__taken"), "already exists")
    )
    return out.withColumns(
        {"message": message, "success": message.isNull(), "__new": F.struct(*[value(c).alias(c) for c in values])}
    ).drop("__ok", "__tk", "__old", "__taken")


def _kept(df: DataFrame, path: str) -> DataFrame:
    """A table written to the shared folder and read back, so that plans do not grow with the rounds."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def map_point_attributes(fields: str | Column, extra: str | Column, create: bool) -> Column:
    """Native attributes of a point from command fields; ``extra`` entries override.

    On create a missing type or class gets its default, empty values are dropped and names ignore
    case. On update there are no defaults, the class cannot change, and an empty type is ignored.
    """
    fields = F.col(fields) if isinstance(fields, str) else fields
    extra = F.coalesce(F.col(extra) if isinstance(extra, str) else extra, text_map({}))
    values: dict[str, Column] = {}
    for name, native in POINT_ATTRIBUTES.items():
        value = F.try_element_at(fields, F.lit(name))
        if create:
            default = POINT_DEFAULTS.get(name)
            values[native] = F.coalesce(value, F.lit(default)) if default else value
        elif name == "pointType":
            values[native] = F.nullif(value, F.lit(""))
        elif name != "pointClass":
            values[native] = value
    keep = (lambda k, v: v.isNotNull() & (v != "")) if create else (lambda k, v: v.isNotNull())
    base, extra = F.map_filter(text_map(values), keep), F.map_filter(extra, keep)
    return merge_ignoring_case(base, extra) if create else override(base, extra)


def suppress_echo(
    changes: DataFrame, sessions: DataFrame, order: Sequence[str], session: str = "replica_session"
) -> DataFrame:
    """Drop the first change of each session that an applied command opened, once per session.

    Session names ignore case. The first change is found by a partial aggregate, so a busy session is
    reduced before a shuffle.
    """
    name = F.lower(F.col(session).cast("string"))
    known = sessions.select(name.alias("__s")).distinct()
    first = (
        changes.filter(F.col(session).isNotNull())
        .groupBy(name.alias("__s"))
        .agg(F.min(F.struct(*order)).alias("__first"))
        .join(known, "__s", "left_semi")
    )
    on = (name == F.col("__s")) & (F.struct(*order) == F.col("__first"))
    return changes.join(first, on, "left_anti")
