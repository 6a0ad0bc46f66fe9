"""Ontology tables: extraction, lookup, refresh and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.operators.lookup import lookup
from changeflow.scratch import shared_path
from changeflow.sinks.tables import write_version

# IRIs of the vocabulary.
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
RDFS_SUBCLASS = "http://www.w3.org/2000/01/rdf-schema#subClassOf"
OWL = "http://www.w3.org/2002/07/owl#"
TERM_TYPES = ("Class", "ObjectProperty", "DatatypeProperty", "NamedIndividual")


def entry_type(type_iri: Column) -> Column:
    """class, individual or property, from the text of a type IRI."""
    text = F.lower(F.coalesce(type_iri, F.lit("")))
    return F.when(text.contains("class"), "class").when(text.contains("individual"), "individual").otherwise("property")


def ontology_from_triples(triples: DataFrame, graph: str | None = None) -> DataFrame:
    """Entries ``iri, label, parent_iri, type`` of a triple table ``s, p, o, o_lang, o_is_blank``.

    Labels count when their language is English or none, parents when they are not blank; both are
    optional. Rows are distinct.
    """
    if graph is not None:
        triples = triples.filter(F.col("g") == graph)
    terms = triples.filter(
        (F.col("p") == RDF_TYPE) & F.col("o").isin(*[OWL + t for t in TERM_TYPES])
    ).select(F.col("s").alias("iri"), entry_type(F.col("o")).alias("type"))
    labels = triples.filter(
        (F.col("p") == RDFS_LABEL) & F.coalesce(F.col("o_lang"), F.lit("")).isin("", "en")
    ).select(F.col("s").alias("iri"), F.col("o").alias("label"))
    parents = triples.filter((F.col("p") == RDFS_SUBCLASS) & ~F.coalesce(F.col("o_is_blank"), F.lit(False))).select(
        F.col("s").alias("iri"), F.col("o").alias("parent_iri")
    )
    return (
        terms.join(labels, "iri", "left")
        .join(parents, "iri", "left")
        .select("iri", "label", "parent_iri", "type")
        .distinct()
    )


def decode_bindings(df: DataFrame, value: str = "value") -> DataFrame:
    """Entries of SPARQL JSON results; bindings without an IRI are skipped, missing sections are empty."""
    term = "struct<value: string>"
    schema = f"struct<results: struct<bindings: array<struct<iri: {term}, label: {term}, parent: {term}, type: {term}>>>>"
    bindings = F.from_json(F.col(value), schema)["results"]["bindings"]
    keep = [c for c in df.columns if c != value]
    return (
        df.select(*keep, F.posexplode(bindings).alias("ordinal", "__b"))
        .filter(F.col("__b.iri.value").isNotNull())
        .select(
            *keep,
            "ordinal",
            F.col("__b.iri.value").alias("iri"),
            F.col("__b.label.value").alias("label"),
            F.col("__b.parent.value").alias("parent_iri"),
            entry_type(F.col("__b.type.value")).alias("type"),
        )
    )


def by_iri(onto: DataFrame, ordinal: str | None = None) -> DataFrame:
    """One entry per IRI, the last in ``ordinal``."""
    entry = F.struct("label", "parent_iri", "type")
    rank = F.col(ordinal) if ordinal else entry
    return onto.groupBy("iri").agg(F.max_by(entry, rank).alias("__e")).select("iri", "__e.*")


def lookup_iri(df: DataFrame, onto: DataFrame, column: str, ordinal: str | None = None, prefix: str = "") -> DataFrame:
    """Label, parent and type of an IRI column, matched with case; unknown IRIs keep NULLs."""
    table = by_iri(onto, ordinal).select(
        F.col("iri").alias("__iri"), *[F.col(c).alias(f"{prefix}{c}") for c in ("label", "parent_iri", "type")]
    )
    return lookup(df, table, [column], ["__iri"]).drop("__iri")


def has_iri(df: DataFrame, onto: DataFrame, column: str) -> DataFrame:
    """Rows whose IRI is in the ontology."""
    table = onto.select(F.col("iri").alias("__iri")).distinct()
    return lookup(df, table, [column], ["__iri"], "left_semi")


def find_label(df: DataFrame, onto: DataFrame, column: str) -> DataFrame:
    """All entries with a label, matched without case; entries without a label never match."""
    table = onto.filter(F.col("label").isNotNull()).select(
        F.lower("label").alias("__label"), "iri", "label", "parent_iri", "type"
    )
    return df.join(table, F.lower(F.col(column)) == F.col("__label")).drop("__label")


def refresh_ontology(new: DataFrame, path: str) -> int:
    """Replace the stored ontology; when the load fails the old version stays current."""
    return write_version(new, path)


def enrich_concepts(events: DataFrame, onto: DataFrame, columns: Sequence[str], ordinal: str | None = None) -> DataFrame:
    """Label, parent and type beside each mapped IRI column. The ontology is reduced to one entry per IRI once, and written, for all columns."""
    spark, path = onto.sparkSession, shared_path(onto.sparkSession, "ontology")
    by_iri(onto, ordinal).write.parquet(path)
    entries = spark.read.parquet(path)
    for column in columns:
        names = {c: f"{column}_{c}" for c in ("label", "parent_iri", "type")}
        table = entries.select(F.col("iri").alias("__iri"), *[F.col(c).alias(n) for c, n in names.items()])
        events = lookup(events, table, [column], ["__iri"]).drop("__iri")
    return events


def crosswalk(events: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Target class and predicate of a source class; table: source_class (unique), target_class, predicate."""
    side = table.select(F.col("source_class").alias("__s"), "target_class", "predicate")
    return lookup(events, side, [column], ["__s"]).drop("__s")
