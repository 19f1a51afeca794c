"""Incremental jobs over newly arriving files."""
