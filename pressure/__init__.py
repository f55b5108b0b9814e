"""Spark jobs over ordered event logs: ingest, clean, star schema, sequence outcomes, marts."""
