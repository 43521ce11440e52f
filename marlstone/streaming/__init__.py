"""Streaming forms of snapshot state: an extension, as snapshots themselves are batches."""
