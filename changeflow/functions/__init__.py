"""Column-level functions: text and addresses, typed values, maps."""
