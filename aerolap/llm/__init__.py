"""Operators of a training-data pipeline: search, formatting, packing, quality
rules, extraction, tokenizing, three deduplications and sharding."""
