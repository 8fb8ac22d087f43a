"""Queries over the test tables, one per operator, with their SQL twins."""
