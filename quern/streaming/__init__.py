"""Structured Streaming: event ingest and incrementally kept aggregates."""
