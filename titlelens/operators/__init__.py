"""Operators: every function takes a DataFrame and returns a lazy DataFrame."""
