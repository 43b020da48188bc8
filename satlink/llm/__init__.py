"""Operators for training-data corpora: tokenizing, scoring, deduplication, sharding, fingerprints.

Nothing outside this package imports it. ``queries.py`` registers one query per operator.
"""
