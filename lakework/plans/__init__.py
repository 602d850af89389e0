"""Whole jobs: ingest, catalog, queries with their SQL."""
