"""Incremental loads and change-data apply."""
