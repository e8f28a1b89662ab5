"""Records analytics on Spark: ingest, typing, marts, checks, documents, enrichment."""
