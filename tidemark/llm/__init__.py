"""Training-data operators: cleaning, deduplication, mixing, tokenisation and packing.

Nothing else in the library imports this subpackage.
"""
