"""Graph operators: patterns, writes, introspection, validation, retrieval, evaluation."""
