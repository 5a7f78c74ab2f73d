"""Column functions: bitmask patterns, time grids, rate cards, and their SQL forms."""
