"""Labelled pair lines and small result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import seeded_order


def pair_line() -> Column:
    return F.concat_ws("\t", "left", "right", F.col("label").cast("string"))


def write_pair_lines(df: DataFrame, path: str, seed: int | str = 42) -> None:
    """Write `left TAB right TAB label` lines in a seeded random order."""
    lines = df.select(pair_line().alias("value"))
    order = seeded_order([F.col("value")], seed)
    lines.orderBy(order, "value").write.mode("overwrite").text(path)


def parse_pair_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Lines to (left, right, label).

    Lines with fewer than three parts are dropped; with more, the first part is
    left, the last the label, and the middle parts are joined by a blank.
    """
    parts = F.split(F.col(line), "\t")
    return (df.select(parts.alias("p")).where(F.size("p") >= 3)
            .select(F.col("p")[0].alias("left"),
                    F.array_join(F.slice("p", F.lit(2), F.size("p") - 2), " ").alias("right"),
                    F.trim(F.element_at("p", -1)).try_cast("int").alias("label")))


def read_pair_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Pair lines; with `limit` the first ones, by file and by place in the file."""
    lines = spark.read.text(path)
    if limit is not None:
        place = ["_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()]
        return parse_pair_lines(lines.orderBy(*place)).limit(limit)
    return parse_pair_lines(lines)


def write_metrics(df: DataFrame, path: str) -> None:
    """Write a metrics row as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
