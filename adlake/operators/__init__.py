"""Operators: transforms, joins, reads, quality checks, equality, statistics, storage, evidence."""
