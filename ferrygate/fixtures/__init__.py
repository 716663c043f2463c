"""Mapping of the generic test tables onto the trade schema, with DuckDB twins."""
