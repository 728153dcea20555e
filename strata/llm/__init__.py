"""Operators of a training-data pipeline: dedup, mixing, scoring, tokenising, archives."""
