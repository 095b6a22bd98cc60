"""Operators for a training-data pipeline: mixing, deduplication, quality, language,
archives, tokenising, licences and sharding.

Each module holds one operator with a general interface; ``queries`` applies every operator
to its whole table with production parameters. Nothing outside this package imports it.
"""
