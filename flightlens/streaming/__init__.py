"""Incremental forms of the hourly cycle, on file streams."""
