"""Operators of a training-data pipeline: deduplication, filtering, scoring, extraction, packing.

Each module holds one operator with a general interface; ``queries`` holds the thin
registered queries. Nothing outside this package imports it.
"""
