"""Column expressions; no data access."""
