"""Column expressions: text, time, geometry, pollen."""
