"""Structured Streaming form of the upsert."""
