"""Incremental append of large result files."""
