"""Operators of a training-data pipeline: scoring, deduplication, mixing, packing, fixity and licence scans."""
