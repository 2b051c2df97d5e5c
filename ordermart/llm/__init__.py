"""Training-data operators: dedup, filtering, mixing, tokenizing, formatting.

Nothing else in the library imports this subpackage.
"""
