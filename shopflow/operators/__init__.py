"""Reusable relational building blocks, each a DataFrame -> DataFrame function."""
