"""Whole plans: the catalog over the star-schema tables, the pipeline, and the query registry."""
