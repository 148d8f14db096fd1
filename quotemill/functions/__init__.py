"""Column expressions: coercion, names, dates, JSON."""
