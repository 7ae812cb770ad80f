"""Structured Streaming ingest: messages -> bronze tables."""
