"""Column expressions: dates, text, units, distances and null-aware aggregates."""
