"""Operators that prepare text for training: archives, tokens, duplicates, quality, packing."""
