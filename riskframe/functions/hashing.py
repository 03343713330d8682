"""Reproducible pseudo-random order from md5, the same in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """0..buckets-1 from the first 32 bits of the digest."""
    bits = F.conv(F.substring(seeded_digest(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(bits, F.lit(buckets)).cast("int")
