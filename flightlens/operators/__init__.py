"""Relational building blocks: joins, ranks, summaries, quality checks."""
