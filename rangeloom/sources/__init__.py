"""Readers: declared datasets, label sets, event interfaces, block streams."""
