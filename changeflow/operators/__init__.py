"""DataFrame operators: change state, mapping, addressing, write-back, ontology, monitoring."""
