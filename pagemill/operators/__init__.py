"""Operators over DataFrames: joins, aggregates, top-k and vector search."""
