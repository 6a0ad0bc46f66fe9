"""Rule-driven mapping of raw rows into key, fields and previous fields.

Rules are compiled to Column expressions when the plan is built, so excluded and unused columns are
pruned at the scan and mapping adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.values import CAST_TYPES, cast_or_keep, cast_value, map_concept, plain_text
from changeflow.operators.lookup import lookup
from changeflow.spec import Rule, check_rules

# The fields a change request must carry, and the change kinds it may name.
REQUIRED_FIELDS = (
    "requestId", "driverId", "sourceType", "entityPath", "changeType", "detectedAt", "primaryKey", "fields",
)
REQUEST_KINDS = ("Insert", "Update", "Delete", "Snapshot")


def apply_mapping(
    df: DataFrame, rules: Sequence[Rule], key: Sequence[str] = (), failed_casts: str = "split"
) -> DataFrame:
    """Add ``pk``, ``fields`` and replace ``prev`` by its mapped form.

    A cast that fails keeps the original: with ``failed_casts="split"`` the typed column is NULL and
    the text is in ``<column>__raw``; with ``"text"`` the column holds text in either case.
    """
    check_rules(rules)
    pk, fields = _mapped(df.schema["row"].dataType, "row", rules, key, failed_casts, statics=True)
    _, prev = (
        _mapped(df.schema["prev"].dataType, "prev", rules, key, failed_casts, statics=False)
        if "prev" in df.columns and isinstance(df.schema["prev"].dataType, T.StructType)
        else ({}, {})
    )
    out = {"pk": _struct(pk), "fields": _struct(fields)}
    if prev:
        out["prev"] = F.when(F.col("prev").isNotNull(), _struct(prev))
    return df.withColumns(out)


def apply_scoped_mapping(
    df: DataFrame, scopes: Mapping[str, Sequence[Rule]], key: Sequence[str] = (), driver: str = "driver_id"
) -> DataFrame:
    """Rules for all drivers (``"*"``) plus rules per driver; ``pk`` and ``fields`` become JSON text.

    One pass over the input: the rule set is chosen per row, a driver's rule replaces a common rule
    for the same column.
    """
    common = {r.source.lower(): r for r in scopes.get("*", ())}
    plans = {}
    for name in [*[d for d in scopes if d != "*"], "*"]:
        own = {r.source.lower(): r for r in scopes.get(name, ())} if name != "*" else {}
        check_rules(scopes.get(name, ()))
        plans[name] = _mapped(
            df.schema["row"].dataType, "row", list({**common, **own}.values()), key, "split", statics=True
        )

    def choose(part: int) -> Column:
        chosen = _json(plans["*"][part])
        for name, plan in plans.items():
            if name != "*":
                chosen = F.when(F.col(driver) == name, _json(plan[part])).otherwise(chosen)
        return chosen

    return df.withColumns({"pk": choose(0), "fields": choose(1)})


def _json(columns: Mapping[str, Column]) -> Column:
    return F.to_json(_struct(columns), {"ignoreNullFields": "false"}) if columns else F.lit("{}")


def _struct(columns: Mapping[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in columns.items()]) if columns else F.lit(None).cast("string")


def _mapped(schema, source, rules, key, failed_casts, statics):
    by_source = {r.source.lower(): r for r in rules}
    keys = {k.lower() for k in key}
    pk: dict[str, Column] = {}
    fields: dict[str, Column] = {}
    spelling: dict[str, str] = {}

    def put(out, name, value):
        # Names ignore case; the first spelling stays, the last value wins.
        out[spelling.setdefault(name.lower(), name)] = value

    if statics:
        for rule in rules:
            if rule.static is not None and not rule.exclude:
                put(pk if rule.is_key else fields, rule.target or rule.source, F.lit(rule.static))
    for field in schema.fields:
        value = F.col(f"{source}.`{field.name}`")
        rule = by_source.get(field.name.lower())
        if rule is None:
            put(pk if field.name.lower() in keys else fields, field.name, value)
            continue
        if rule.exclude:
            continue
        out = pk if rule.is_key else fields
        target = rule.target or field.name
        typed, raw, dtype = _cast(value, rule, field.dataType, failed_casts)
        if rule.concepts:
            text = plain_text(typed, dtype) if raw is None else F.coalesce(plain_text(typed, dtype), raw)
            put(out, target, map_concept(text, T.StringType(), rule.concepts))
        else:
            put(out, target, typed)
            if raw is not None:
                put(out, f"{target}__raw", raw)
    return pk, fields


def _cast(value, rule, dtype, failed_casts):
    """The cast value, the kept original (None when nothing can fail) and the resulting type."""
    name = (rule.type or "").lower()
    if name not in CAST_TYPES:  # also an unknown type name leaves the value
        return value, None, dtype
    target = CAST_TYPES[name]
    if name == "string" or dtype == target:
        return cast_value(value, name, dtype), None, target
    typed, raw = cast_or_keep(value, name, dtype)
    if failed_casts == "text":
        return F.coalesce(plain_text(typed, target), raw), None, T.StringType()
    return typed, raw, target


def map_concepts(df: DataFrame, column: str, concepts: DataFrame, into: str | None = None) -> DataFrame:
    """Concept lookup against a table ``(value, concept)`` with unique values; a miss keeps the value."""
    table = concepts.select(F.col("value").alias("__cv"), F.col("concept").alias("__cc"))
    value = F.col(column).cast("string")
    return (
        lookup(df, table, [value], ["__cv"])
        .withColumn(into or column, F.coalesce(F.col("__cc"), value))
        .drop("__cv", "__cc")
    )


def check_request(df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, kind: str = "changeType") -> DataFrame:
    """Add ``errors``: a message per missing field, and one for an unknown change kind."""

    def missing(name: str) -> Column:
        value = F.col(name)
        blank = isinstance(df.schema[name].dataType, T.StringType)
        return value.isNull() | (F.trim(value) == "") if blank else value.isNull()

    checks = [F.when(missing(n), F.lit(f"{n} is required")) for n in required]
    known = F.lit(f"{kind} must be one of: {', '.join(REQUEST_KINDS)}")
    checks.append(F.when(~missing(kind) & ~F.col(kind).isin(*REQUEST_KINDS), known))
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with errors."""
    return df.filter(F.size("errors") == 0), df.filter(F.size("errors") > 0)


def resolve_concepts(
    df: DataFrame,
    resolvers: Sequence[tuple[str, str, str, str]],
    attributes: Mapping[str, str],
    ontology_version: str | None,
) -> DataFrame:
    """First matching resolver (entity, predicate, concept, context) gives concept and context.

    ``attributes`` are templates over columns, e.g. ``"asset:{id}"``. Events without a concept or an
    ontology version get an entry in ``errors``.
    """
    concept, context = F.lit(None).cast("string"), F.lit(None).cast("string")
    for entity, predicate, name, where in reversed(resolvers):
        hit = (F.col("entity") == entity) & F.coalesce(F.expr(predicate), F.lit(False))
        concept = F.when(hit, F.lit(name)).otherwise(concept)
        context = F.when(hit, F.lit(where)).otherwise(context)
    out = df.withColumns({"concept": concept, "context": context, **{n: fill(t) for n, t in attributes.items()}})
    return out.withColumn("ontology_version", F.lit(ontology_version).cast("string")).withColumn(
        "errors",
        F.array_compact(
            F.array(
                F.when(F.col("concept").isNull(), "concept is required"),
                F.when(F.col("ontology_version").isNull(), "ontology version is required"),
            )
        ),
    )


def fill(template: str) -> Column:
    """A template over columns: ``{name}`` is replaced by the column's text."""
    parts, rest = [], template
    while "{" in rest:
        head, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(head), F.col(name).cast("string")]
    return F.concat(*parts, F.lit(rest))
