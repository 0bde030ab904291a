"""Views derived from the given tables, the query registry and its SQL twins."""
