"""DataFrame-level operators: joins, lookups, documents, delta and day filters."""
