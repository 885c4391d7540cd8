"""Readers and writers: web archives, tolerant JSON lines, manifests, Parquet."""
