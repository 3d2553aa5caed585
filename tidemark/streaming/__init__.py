"""Structured Streaming: bounded ingest, dedupe, counts, cursors and change application."""
