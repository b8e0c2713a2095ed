"""Structured Streaming counterparts of the incremental loads."""
