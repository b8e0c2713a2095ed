"""DataFrame-level operators (joins, computed columns, aggregates, cleaning, checks, ordered scans)."""
