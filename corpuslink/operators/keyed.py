"""One row per key, key sets and rows selected by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_key


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # The rank filter also runs before the shuffle, so each task sends at most
    # one row per key however often the key occurs.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every key in the given order."""
    return _one_per_key(df, keys, [F.col(c).asc() for c in order])


def upsert_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of every key in the given order (last write wins)."""
    return _one_per_key(df, keys, [F.col(c).desc() for c in order])


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct normalised keys that are not null, in a column `key`."""
    return df.select(normalize_key(F.col(key).cast("string")).alias("key")).dropna().distinct()


def common_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys present in both `key` columns."""
    return a.join(b, "key", "left_semi")


def keep_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is in the `key` column of `keys`."""
    return df.join(keys.select(F.col("key").alias(key)), key, "left_semi")


def keep_common(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> tuple[DataFrame, DataFrame]:
    """Both sources reduced to keys they share."""
    ka = a.select(F.col(a_key).alias("key"))
    kb = b.select(F.col(b_key).alias("key"))
    return keep_keys(a, a_key, kb), keep_keys(b, b_key, ka)
