"""Schemas, loaders and writers of the Parquet tables."""
