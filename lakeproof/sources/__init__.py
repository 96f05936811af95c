"""Pinned specs, delimited text, lake tables, constraint catalogs."""
