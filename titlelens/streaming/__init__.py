"""Incremental cleaning of newly landed files."""
