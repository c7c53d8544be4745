"""Whole jobs: read tables, run operators, write tables."""
