"""Operators for preparing training text: scoring, deduplication, filtering, packing.

Nothing outside this folder imports it; ``queries`` holds its registered queries and their SQL.
"""
