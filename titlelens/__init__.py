"""Catalog analytics as lazy DataFrame-to-DataFrame functions on PySpark."""
