"""DataFrame operators: joins, aggregations, windows and the few Arrow-backed steps."""
