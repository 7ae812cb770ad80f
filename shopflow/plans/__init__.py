"""Composite outputs: silver history tables and gold business outputs."""
