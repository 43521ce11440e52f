"""Readers of landed files: JSON arrays, feeds, curves, registries. Fetching over a network is left to the caller."""
