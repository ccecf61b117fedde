"""Operators of a training-data pipeline: dedup, quality, packing, tokens, search and scans."""
