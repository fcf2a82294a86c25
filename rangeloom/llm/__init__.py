"""Operators for preparing training text at scale: deduplication, filtering, tokenising and packing.

Nothing outside this package imports it; the driver entry file adds its queries when it is present.
"""
