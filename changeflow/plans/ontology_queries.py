"""Registered queries: ontology tables derived from nations, regions and market segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.operators import ontology
from changeflow.operators.ontology import OWL, RDF_TYPE, RDFS_LABEL, RDFS_SUBCLASS
from changeflow.plans.tables import read
from changeflow.scratch import shared_path
from changeflow.sinks.tables import read_version


def _triples(spark, sf):
    """Nations are classes below their region, suppliers individuals, customers properties with two labels."""
    nation, region, supplier, customer = (read(spark, sf, n) for n in ("nation", "region", "supplier", "customer"))

    def t(df, s, p, o, lang=None, blank=False):
        return df.select(
            s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(lang).cast("string").alias("o_lang"), F.lit(blank).alias("o_is_blank"),
            F.lit("g:main").alias("g"),
        )

    iri = lambda kind, key: F.concat(F.lit(f"ex:{kind}/"), key)
    n, r = iri("nation", F.col("n_nationkey")), iri("region", F.col("r_regionkey"))
    s, c = iri("supplier", F.col("s_suppkey")), iri("customer", F.col("c_custkey"))
    parts = [
        t(nation, n, RDF_TYPE, F.lit(OWL + "Class")), t(nation, n, RDFS_LABEL, F.col("n_name")),
        t(nation, n, RDFS_SUBCLASS, iri("region", F.col("n_regionkey"))),
        t(nation, n, RDFS_SUBCLASS, F.concat(F.lit("_:b"), "n_nationkey"), blank=True),
        t(region, r, RDF_TYPE, F.lit(OWL + "Class")), t(region, r, RDFS_LABEL, F.col("r_name"), "en"),
        t(region, r, RDFS_LABEL, F.concat(F.lit("le "), "r_name"), "fr"),
        t(supplier, s, RDF_TYPE, F.lit(OWL + "NamedIndividual")), t(supplier, s, RDFS_LABEL, F.col("s_name"), "de"),
        t(customer, c, RDF_TYPE, F.lit(OWL + "DatatypeProperty")), t(customer, c, RDFS_LABEL, F.col("c_name")),
        t(customer, c, RDFS_LABEL, F.lower("c_mktsegment"), "en"), t(customer, c, RDF_TYPE, F.lit(OWL + "Thing")),
        t(customer, c, RDF_TYPE, F.lit(OWL + "ObjectProperty")).withColumn("g", F.lit("g:other")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _ontology(spark, sf):
    return ontology.ontology_from_triples(_triples(spark, sf), "g:main")


def ontology_extract(spark, sf):
    return _ontology(spark, sf).orderBy("iri")


def bindings_decode(spark, sf):
    """Result documents of up to 50 customers, one binding each; some bindings lack parts."""
    c = read(spark, sf, "customer")
    term = lambda v: F.struct(v.alias("value"))
    binding = F.struct(
        F.when(F.col("c_acctbal") > 0, term(F.concat(F.lit("ex:"), "c_custkey"))).alias("iri"),
        F.when(F.col("c_mktsegment") != "BUILDING", term(F.col("c_name"))).alias("label"),
        F.when(F.col("c_mktsegment") == "MACHINERY", term(F.col("c_mktsegment"))).alias("parent"),
        term(F.concat(F.lit(OWL), F.when(F.col("c_mktsegment") == "FURNITURE", "namedindividual").when(F.col("c_mktsegment") == "HOUSEHOLD", "CLASS").otherwise("ObjectProperty"))).alias("type"),
    )
    docs = c.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(F.collect_list(binding).alias("b")).select(
        "page", F.to_json(F.struct(F.struct(F.col("b").alias("bindings")).alias("results"))).alias("value")
    )
    docs = docs.unionByName(read(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("page"), F.lit('{"head":{}}').alias("value")))
    return ontology.decode_bindings(docs).select("page", "iri", "label", "parent_iri", "type")


def _customer_terms(spark, sf):
    return read(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("ex:nation/"), "c_nationkey").alias("nation_iri"),
        F.concat(F.lit("EX:Nation/"), "c_nationkey").alias("other_iri"), F.lower("c_mktsegment").alias("segment"),
    )


def lookup_iri(spark, sf):
    """Entries with several labels: the last by label wins."""
    suppliers = read(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("ex:customer/"), "o_custkey").alias("who"))
    onto = _ontology(spark, sf)
    return ontology.lookup_iri(suppliers, onto, "who", "label").select("o_orderkey", "who", "label", "parent_iri", "type")


def has_iri(spark, sf):
    terms = _customer_terms(spark, sf)
    onto = _ontology(spark, sf)
    hit = ontology.has_iri(terms, onto, "nation_iri").select("c_custkey", F.col("nation_iri").alias("iri"))
    return hit.unionByName(ontology.has_iri(terms, onto, "other_iri").select("c_custkey", F.col("other_iri").alias("iri")))


def find_label(spark, sf):
    regions = read(spark, sf, "region").select(F.initcap("r_name").alias("name")).unionByName(
        read(spark, sf, "nation").select(F.lower("n_name").alias("name"))
    )
    return ontology.find_label(regions, _ontology(spark, sf), "name").select("name", "iri", "label", "type")


def enrich_concepts(spark, sf):
    terms = _customer_terms(spark, sf).select("c_custkey", "nation_iri", "other_iri")
    return ontology.enrich_concepts(terms, _ontology(spark, sf), ["nation_iri", "other_iri"], "label")


def ontology_refresh(spark, sf):
    """Two loads; the second replaces the first whole."""
    path = shared_path(spark, "ontology")
    onto = _ontology(spark, sf)
    ontology.refresh_ontology(onto, path)
    ontology.refresh_ontology(onto.filter("type <> 'property'"), path)
    return read_version(spark, path)


def crosswalk(spark, sf):
    name = F.when(F.col("n_nationkey") == 4, "other").otherwise(F.col("n_nationkey").cast("string"))
    nations = read(spark, sf, "nation").select(
        F.concat(F.lit("ex:nation/"), name).alias("source_class"), F.concat(F.lit("geo:"), "n_regionkey").alias("target_class"),
        F.lit("skos:broadMatch").alias("predicate"),
    )
    return ontology.crosswalk(_customer_terms(spark, sf), nations, "nation_iri").select("c_custkey", "nation_iri", "target_class", "predicate")


QUERIES = {
    f.__name__: f
    for f in (
        ontology_extract, bindings_decode, lookup_iri, has_iri, find_label, enrich_concepts, ontology_refresh, crosswalk,
    )
}

_TERMS = """o AS (
  SELECT 'ex:nation/' || n_nationkey AS iri, n_name AS label, 'ex:region/' || n_regionkey AS parent_iri, 'class' AS type FROM nation
  UNION ALL SELECT 'ex:region/' || r_regionkey, r_name, NULL, 'class' FROM region
  UNION ALL SELECT 'ex:supplier/' || s_suppkey, NULL, NULL, 'individual' FROM supplier
  UNION ALL SELECT 'ex:customer/' || c_custkey, unnest([c_name, lower(c_mktsegment)]), NULL, 'property' FROM customer)"""

ORACLE = {
    "ontology_extract": f"WITH {_TERMS} SELECT * FROM o",
    "bindings_decode": """SELECT c_custkey // 50 AS page, 'ex:' || c_custkey AS iri, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS label,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN c_mktsegment END AS parent_iri,
        CASE c_mktsegment WHEN 'FURNITURE' THEN 'individual' WHEN 'HOUSEHOLD' THEN 'class' ELSE 'property' END AS type FROM customer WHERE c_acctbal > 0""",
    "lookup_iri": """SELECT o_orderkey, 'ex:customer/' || o_custkey AS who, greatest(c_name, lower(c_mktsegment)) AS label,
        NULL::VARCHAR AS parent_iri, CASE WHEN c_custkey IS NOT NULL THEN 'property' END AS type
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "has_iri": "SELECT c_custkey, 'ex:nation/' || c_nationkey AS iri FROM customer",
    "find_label": f"""WITH {_TERMS} SELECT upper(left(r_name, 1)) || lower(substr(r_name, 2)) AS name, iri, label, type FROM region JOIN o ON lower(label) = lower(r_name)
        WHERE r_name NOT LIKE '% %' UNION ALL SELECT 'Middle East', iri, label, type FROM region JOIN o ON lower(label) = lower(r_name) WHERE r_name = 'MIDDLE EAST'
        UNION ALL SELECT lower(n_name), iri, label, type FROM nation JOIN o ON lower(label) = lower(n_name)""",
    "enrich_concepts": """SELECT c_custkey, 'ex:nation/' || c_nationkey AS nation_iri, 'EX:Nation/' || c_nationkey AS other_iri,
        n_name AS nation_iri_label, 'ex:region/' || n_regionkey AS nation_iri_parent_iri, CASE WHEN n_name IS NOT NULL THEN 'class' END AS nation_iri_type,
        NULL::VARCHAR AS other_iri_label, NULL::VARCHAR AS other_iri_parent_iri, NULL::VARCHAR AS other_iri_type
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "ontology_refresh": f"WITH {_TERMS} SELECT * FROM o WHERE type <> 'property'",
    "crosswalk": """SELECT c_custkey, 'ex:nation/' || c_nationkey AS nation_iri, 'geo:' || n_regionkey AS target_class,
        CASE WHEN n_nationkey IS NOT NULL THEN 'skos:broadMatch' END AS predicate
        FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 4) ON c_nationkey = n_nationkey""",
}
