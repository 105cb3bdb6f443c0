"""Text corpora, landed pages and article metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import page_name


def read_text_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Folder of `.txt` files as (nome, contenuto, path), one row per file."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    return files.select(F.col("_metadata.file_name").alias("nome"),
                        F.col("value").alias("contenuto"),
                        F.col("_metadata.file_path").alias("path"))


def read_html_pages(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Folder of landed `.html` files as (paper_id, source, html)."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.html")
    return files.select(page_name(F.col("_metadata.file_name")).alias("paper_id"),
                        F.lit(source).alias("source"), F.col("value").alias("html"))


def valid_page(df: DataFrame, min_bytes: int, html: str = "html") -> DataFrame:
    """Pages with more than `min_bytes` bytes."""
    return df.where(F.octet_length(html) > min_bytes)


def corpus_from_table(df: DataFrame, name_col: str, text_col: str, order: list[str] | None = None,
                      limit: int | None = None) -> DataFrame:
    """A table's title and text columns as (nome, contenuto)."""
    if limit is not None:
        df = df.orderBy(*(order or [name_col])).limit(limit)
    return df.select(F.col(name_col).alias("nome"), F.col(text_col).alias("contenuto"))


def parse_id_list(df: DataFrame, json_col: str) -> DataFrame:
    """`esearchresult.idlist` of a JSON column, one row per id."""
    parsed = F.from_json(json_col, "esearchresult struct<idlist: array<string>>")
    return df.withColumn("id", F.explode(parsed["esearchresult"]["idlist"]))


def write_token_dump(tokens: DataFrame, path: str) -> None:
    tokens.write.mode("overwrite").json(path)
