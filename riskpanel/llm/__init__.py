"""Operators of a training-data pipeline: language id, deduplication, sharding,
toxicity, token counts, vector search, mixing and packing.

One module per operator; ``queries`` registers one query for each. Nothing
else in the library imports this subpackage.
"""
