"""Scans and sinks: landing documents, partitioned tables, batch sinks."""
