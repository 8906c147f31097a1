"""Whole jobs: explore, train, score."""
