"""Seeded three-way split and fold numbers by a stable hash of the row key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateralis.config import SplitConfig
from lateralis.functions.columns import col, hash_bucket

SEED = 42
BUCKETS = 10_000


SPLIT = "_split"


@dataclass(frozen=True)
class Splits:
    """Three frames, and ``labelled`` with all rows and the name of each one's split in ``SPLIT``, for one pass over all."""

    train: DataFrame
    valid: DataFrame
    test: DataFrame | None
    labelled: DataFrame


def split_label(key: Column, settings: SplitConfig = SplitConfig(), seed: int = SEED) -> Column:
    """``test``, ``valid`` or ``train``: the test share of all rows, then the valid share of the rest.

    A narrow expression: no shuffle, and the same rows whatever the partitioning.
    """
    test, rest = _cuts(settings)
    bucket = hash_bucket(key, seed, BUCKETS)
    return F.when(bucket < test, "test").when(bucket < rest, "valid").otherwise("train")


def _cuts(settings: SplitConfig) -> tuple[int, int]:
    """The first bucket after the test rows and the first one after the valid rows."""
    test = round(BUCKETS * settings.test_ratio) if settings.test else 0
    return test, test + round((BUCKETS - test) * settings.valid_ratio)


def split_rows(df: DataFrame, key: str, settings: SplitConfig = SplitConfig(), seed: int = SEED) -> Splits:
    """The parts are ranges of buckets, so that a filter hashes a key once for most rows; without a key a row is for training."""
    test, rest = _cuts(settings)
    bucket = F.coalesce(hash_bucket(col(key), seed, BUCKETS), F.lit(BUCKETS))
    labelled = df.withColumn(SPLIT, split_label(col(key), settings, seed))
    df = labelled.drop(SPLIT)
    return Splits(
        df.where(bucket >= rest), df.where((bucket < rest) & (bucket >= test)), df.where(bucket < test) if settings.test else None, labelled
    )


def split_parts(labelled: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """The rows of each named split of a frame with ``SPLIT``."""
    return {name: labelled.where(F.col(SPLIT) == name).drop(SPLIT) for name in names}


def fold_number(key: Column, folds: int, seed: int = SEED) -> Column:
    """Fold 0..folds-1; the seed is shifted so that folds are independent of the three-way split."""
    return hash_bucket(key, seed + 1, folds).cast("int")
