"""Operators of a training-data pipeline: near-duplicates, decontamination,
quality, toxicity, secrets, language, sharding, packing and token files.

Nothing else in the library imports this package. ``queries`` holds the
registered queries and their DuckDB twins.
"""
