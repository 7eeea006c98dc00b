"""Column expressions: cleaning, time, geometry, names."""
