"""Reproducible train/test splits and folds.

Both depend on key values only: the same row lands on the same side whatever the partitioning,
the cluster size or the number of recomputations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tabloom.functions.keys import arithmetic_bucket, hash_bucket

SPLIT_BUCKETS = 100
# Folds are drawn with another seed than the split, else a fold would be all train or all test.
FOLD_SEED_SHIFT = 7_919


def _bucket(df: DataFrame, keys: Sequence[str], buckets: int, seed: int, method: str) -> Column:
    # Without keys the whole row decides; equal rows then share a side.
    keys = list(keys) or df.columns
    if method == "hash":
        return hash_bucket(keys, buckets, seed)
    if method == "arithmetic":
        return arithmetic_bucket(keys, buckets, seed)
    raise ValueError(f"method must be 'hash' or 'arithmetic', not {method!r}")


def split(
    df: DataFrame, keys: Sequence[str] = (), train_percent: int = 90, seed: int = 42, method: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: two filters over ``df``, disjoint and together complete."""
    bucket = _bucket(df, keys, SPLIT_BUCKETS, seed, method)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def add_fold(
    df: DataFrame, keys: Sequence[str] = (), folds: int = 10, seed: int = 42, method: str = "hash", fold_column: str = "fold"
) -> DataFrame:
    """``df`` with a fold number 0..folds-1."""
    return df.withColumn(fold_column, _bucket(df, keys, folds, seed + FOLD_SEED_SHIFT, method))
