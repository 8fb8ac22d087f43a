"""Whole-table builds composed from the operators."""
