"""Counts, attribute profiles and timing summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scale import ordered_ids

DIGEST = 64  # characters of a SHA-256


def count_by_source(df: DataFrame, column: str = "source", total: bool = True) -> DataFrame:
    """Rows per source and, under the name `ALL`, in total."""
    counts = df.groupBy(F.col(column).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if not total:
        return counts
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return counts.unionByName(whole.select(F.lit("ALL").alias("source"), "n"))


def feature_analysis(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: null and blank percentage and number of distinct values.

    Values are counted per (attribute, value) first, so a frequent value is
    reduced to one row before the shuffle. A value longer than its SHA-256
    travels as that digest; digests of different values differ for all purposes.
    """
    columns = list(columns or df.columns)

    def cell(name: str) -> Column:
        v = F.col(name).cast("string")
        digested = F.length(v) > DIGEST
        return F.struct(F.lit(name).alias("attribute"), digested.alias("digested"),
                        F.when(digested, F.sha2(v, 256)).otherwise(v).alias("v"))

    cells = F.explode(F.array(*map(cell, columns))).alias("x")
    values = (df.select(cells).groupBy("x.attribute", "x.digested", "x.v")
              .agg(F.count(F.lit(1)).alias("n")))
    share = lambda cond: F.round(
        100 * F.sum(F.when(cond, F.col("n")).otherwise(0)) / F.sum("n"), 2)
    return values.groupBy("attribute").agg(
        share(F.col("v").isNull()).alias("null_pct"),
        share(F.col("v") == "").alias("blank_pct"),
        F.count("v").alias("unique"))


def summarize(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """n, sum, mean, min, max and exact median of one column per group.

    For the median, equal values are counted together and the counts are added
    up over range partitions; no group is held in one task.
    """
    by = list(by)
    df = df.select(*by, F.col(column).alias("x"))
    basics = df.groupBy(*by).agg(
        F.count("x").alias("n"), F.sum("x").alias("sum"), F.avg("x").alias("mean"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    values = df.dropna(subset=["x"]).groupBy(*by, "x").agg(F.count(F.lit(1)).alias("c"))
    ranked = ordered_ids(values, ["x"], "before", by, "total", "c")
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    holds = lambda r: (F.col("before") <= r) & (r < F.col("before") + F.col("c"))
    middle = (ranked.where(holds(low) | holds(high)).groupBy(*by)
              .agg(F.avg("x").alias("median")))
    if not by:
        key = F.lit(1).alias("k")
        return (basics.select(key, "*").join(middle.select(key, "median"), "k", "left").drop("k"))
    return basics.join(middle, by, "left")
