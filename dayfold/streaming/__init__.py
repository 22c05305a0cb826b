"""Structured Streaming jobs: incremental ingest and live queue state."""
