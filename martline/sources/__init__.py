"""Sources: driver tables, files (CSV / JSON / nested JSON), landed payloads, lake snapshots."""
