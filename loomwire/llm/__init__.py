"""Operators of a training-data pipeline: rules, deduplication, packing, mixing, scoring, archives."""
