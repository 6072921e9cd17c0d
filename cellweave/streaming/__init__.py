"""Incremental conversion."""
