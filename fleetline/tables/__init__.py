"""Versioned tables of the ingest store: manifest, bucketed tables, id index."""
