"""DataFrame operators: joins, aggregates, windows and numbering."""
