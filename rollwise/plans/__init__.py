"""Plans over specs: one chunk, a range in one job, registry-wide operators, the persisted registry."""
