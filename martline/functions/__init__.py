"""Column-level function helpers (aggregate registry, text, dates, JSON)."""
