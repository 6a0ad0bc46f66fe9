"""All registered queries and their SQL twins."""

from changeflow.plans import (
    capture_queries,
    change_queries,
    command_queries,
    document_queries,
    mapping_queries,
    monitor_queries,
    ontology_queries,
    sink_queries,
    stream_queries,
)

MODULES = (
    change_queries, capture_queries, mapping_queries, sink_queries, document_queries, command_queries, ontology_queries,
    monitor_queries, stream_queries,
)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
