"""Comparing, merging and patching versions of a table."""
