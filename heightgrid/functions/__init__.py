"""Column-level functions: geometry, projections, seeded randomness, text."""
