"""Trending-topic analytics on Spark: one set of DataFrame transforms for batch and streaming."""
