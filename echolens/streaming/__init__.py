"""Structured Streaming jobs (dedupe ingest, weekly windows, score-and-append)."""
