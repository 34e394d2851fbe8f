"""Named jobs, the query registry and their DuckDB oracle text."""
