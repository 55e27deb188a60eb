"""Operators of a training-data pipeline: quality, dedup, language, toxicity, tokens, packing, search."""
