"""Column expressions: names and patterns, time, map projections."""
