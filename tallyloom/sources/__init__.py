"""CSV reading with typing and quarantine, Parquet tables, CSV writing."""
