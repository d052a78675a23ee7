"""Catalogue analytics on Spark: ingest, publish, replicate, score and rank."""
