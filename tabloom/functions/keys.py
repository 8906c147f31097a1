"""Row buckets that depend on key values only, so they survive recomputation and repartitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def hash_bucket(keys: Sequence[str], buckets: int, seed: int = 0) -> Column:
    """Bucket 0..buckets-1 from a 64-bit hash of the key columns."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


# Primes for the arithmetic bucket below.
KEY_MODULUS = 1_000_003
KEY_MULTIPLIER = 7_919
SEED_STEP = 104_729


def seeded_multiplier(seed: int) -> int:
    """The factor of a seed, 1..KEY_MODULUS-1. Buckets of two seeds are then no shifts of each other."""
    return (KEY_MULTIPLIER + seed * SEED_STEP) % (KEY_MODULUS - 1) + 1


def arithmetic_bucket(keys: Sequence[str], buckets: int, seed: int = 0) -> Column:
    """Bucket 0..buckets-1 from integer arithmetic on integer keys.

    Weaker mixing than ``hash_bucket`` but easy to repeat in any SQL dialect. Every
    intermediate value stays below 2**41, so it cannot overflow a bigint.
    """
    factor, total = F.lit(seeded_multiplier(seed)).cast("bigint"), F.lit(0).cast("bigint")
    for key in keys:
        folded = F.pmod(F.col(key).cast("bigint"), F.lit(KEY_MODULUS).cast("bigint"))
        total = F.pmod((total + folded) * factor, F.lit(KEY_MODULUS).cast("bigint"))
    return F.pmod(total, F.lit(buckets)).cast("int")
