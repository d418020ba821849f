"""Splits and folds that follow from the key alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.functions.hashing import hash_bucket, key_digest

DEFAULT_SPLIT = {"train": 0.8, "val": 0.1, "test": 0.1}


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    weights: Mapping[str, float] = DEFAULT_SPLIT,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Tag each row with a split, by a hash of its key.

    A seeded ``randomSplit`` gives other rows once the input is partitioned otherwise; this does not.
    A row key splits row by row; an entity key keeps all of an entity's rows in one split.
    """
    if not weights or any(w < 0 for w in weights.values()) or sum(weights.values()) <= 0:
        raise ValueError("weights must be non-negative and not all zero.")
    total, names = sum(weights.values()), list(weights)
    place = key_digest(*keys, seed=seed)
    reached, cuts = 0.0, []
    for part in names[:-1]:
        reached += weights[part]
        cuts.append((part, round(reached / total * (1 << 32))))
    tag = F.lit(names[-1])
    for part, cut in reversed(cuts):
        # Hex digits of one width sort as their numbers do, so the digest need not become a number.
        under = place < F.lit(f"{cut:08x}") if cut < 1 << 32 else F.lit(True)
        tag = F.when(under, F.lit(part)).otherwise(tag)
    return df.withColumn(name, tag)


def with_fold(
    df: DataFrame, keys: Sequence[str], folds: int = 4, seed: int = 7, name: str = "fold"
) -> DataFrame:
    """Tag each row with a cross-validation fold in ``[0, folds)``, by a hash of its key."""
    return df.withColumn(name, hash_bucket(folds, *keys, seed=seed))
