"""Hashes that depend on the key's value alone, so that they outlive a repartition or a retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(*keys: Column | str, seed: int = 42) -> Column:
    """``md5(seed:key[:key...])`` in hex."""
    texts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("null")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def hash32(*keys: Column | str, seed: int = 42) -> Column:
    """The first 32 bits of the key's digest as a bigint. Any SQL engine can repeat it."""
    return F.conv(F.substring(key_digest(*keys, seed=seed), 1, 8), 16, 10).cast("bigint")


def hash_bucket(n: int, *keys: Column | str, seed: int = 42) -> Column:
    """An int bucket in ``[0, n)``."""
    if n <= 0:
        raise ValueError("n must be a positive integer.")
    return F.pmod(hash32(*keys, seed=seed), F.lit(n)).cast("int")
