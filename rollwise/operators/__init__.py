"""DataFrame operators: aggregation, rollups, upserts, target tables, rate cards, joins."""
