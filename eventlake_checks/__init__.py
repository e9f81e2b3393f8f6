"""Check inputs, registered queries and their DuckDB equivalents."""
