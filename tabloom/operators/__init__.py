"""Distributed operators: DataFrames in, DataFrames (or fitted models) out."""
