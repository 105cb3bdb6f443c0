"""Seeded sampling and splitting with exact sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import ordered_ids, seeded_order, shuffled_rank


def sample_keys(df: DataFrame, id_cols: Sequence[str], n: int, seed: int | str) -> DataFrame:
    """n random rows (all when fewer); ids must be unique.

    Each row's place in the seeded order is counted bucket-wise, so n may be as
    large as the table.
    """
    return shuffled_rank(df, id_cols, seed, "__rank").where(F.col("__rank") < n).drop("__rank")


def sample_rows(df: DataFrame, source: str, id_cols: Sequence[str], n: int, seed: int | str,
                source_col: str = "source") -> DataFrame:
    """n random rows of one source."""
    return sample_keys(df.where(F.col(source_col) == source), id_cols, n, seed)


def split_pairs(df: DataFrame, id_cols: Sequence[str], seed: int | str = 42,
                holdout: float = 0.4, test_share: float = 0.5) -> DataFrame:
    """Adds `split`: train, val or test, with exact sizes.

    The held-out part has ceil(holdout * n) rows, its test part
    ceil(test_share * held-out) of them.
    """
    held = F.ceil(F.col("__n") * F.lit(holdout))
    test = F.ceil(held * F.lit(test_share))
    ranked = shuffled_rank(df, id_cols, seed, "__rank", total="__n")
    return ranked.withColumn(
        "split", F.when(F.col("__rank") < test, "test")
        .when(F.col("__rank") < held, "val").otherwise("train")).drop("__rank", "__n")


def shuffle(df: DataFrame, id_cols: Sequence[str], seed: int | str) -> DataFrame:
    """Rows in a seeded random order."""
    return df.orderBy(seeded_order([F.col(c) for c in id_cols], seed), *id_cols)


def with_row_ids(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Dense 0-based ids in the given order."""
    return ordered_ids(df, order, name)


def latest_papers(df: DataFrame, n: int = 10, date: str = "date", tie: str = "document_id") -> DataFrame:
    """The n newest rows."""
    return df.orderBy(F.col(date).desc(), F.col(tie)).limit(n)


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*order).limit(n)
