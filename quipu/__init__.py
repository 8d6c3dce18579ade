"""Retail constellation mart and table comparison on PySpark."""
