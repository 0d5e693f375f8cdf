"""Structured Streaming forms of the rollup and of the alert outbox."""
