"""Structured Streaming jobs: decode change events and card events, mask
card feeds, and land everything as date-partitioned Parquet."""
