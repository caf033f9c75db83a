"""Readers and writers (Parquet, CSV, LibSVM) and test-table role adapters."""
