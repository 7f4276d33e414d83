"""Readers, writers and the adapter for the driver's Parquet tables."""
