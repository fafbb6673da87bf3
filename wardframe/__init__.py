"""Staffing analytics on Spark: typed ingest, Gold tables, metrics and profiling."""
