"""Check queries (Spark) and their DuckDB oracles, one per SURVEY section 2 key."""
