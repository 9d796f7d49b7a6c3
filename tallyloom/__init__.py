"""Retail sales analytics on Spark: ingest, audit, reconcile, trend and forecast."""
