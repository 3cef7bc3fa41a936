"""Operators that prepare text for training: counts, quality, mixing, formatting, packing, search."""
