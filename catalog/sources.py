"""Sources and sinks: the given tables are written to the shared folder, read back and returned."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators.postings import token_dump
from corpuslink.operators.scale import shared_folder
from corpuslink.sources import corpus, pairs, records

from .common import STANDARD, table


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/catalog/{uuid.uuid4().hex}"


def csv_source(spark: SparkSession, d: str) -> DataFrame:
    """Documents as quoted CSV with texts over many lines."""
    path = _folder(spark)
    records.write_sources(table(spark, d, "documents").select("doc_id", "text", "lang", "source"), path)
    return records.read_csv_source(spark, path)


def csv_parts(spark: SparkSession, d: str) -> DataFrame:
    """The same CSV, its byte ranges read by separate tasks."""
    path = _folder(spark)
    records.write_sources(table(spark, d, "documents").select("doc_id", "text", "lang", "source"), path)
    return records.read_csv_parts(spark, path)


def csv_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events, one line each, read in parts under a schema."""
    path = _folder(spark)
    records.write_sources(table(spark, d, "events").select("event_id", "user_id"), path)
    return records.read_csv_source(spark, path, ["event_id", "user_id"], "event_id bigint, user_id bigint",
                                   multi_line=False)


def csv_as_parquet(spark: SparkSession, d: str) -> DataFrame:
    """The documents' CSV, converted once."""
    path = _folder(spark)
    records.write_sources(table(spark, d, "documents").select("doc_id", "text"), path)
    return records.csv_to_parquet(spark, path, f"{path}-parquet", "doc_id bigint, text string")


def keyed_source(spark: SparkSession, d: str) -> DataFrame:
    """The last document of each source and language."""
    path = _folder(spark)
    records.write_keyed(table(spark, d, "documents"), ["source", "lang"], path, ["doc_id"])
    return spark.read.parquet(path).select("source", "lang", "doc_id", "text")


def pair_source(spark: SparkSession, d: str) -> DataFrame:
    """Language and first line of each document as a labelled pair line."""
    path = _folder(spark)
    docs = table(spark, d, "documents")
    pairs.write_pair_lines(docs.select(F.concat("source", F.lit(" "), "doc_id").alias("left"),
                                       F.substring_index("text", "\n", 1).alias("right"),
                                       (F.col("doc_id") % 2).cast("int").alias("label")), path)
    return pairs.read_pair_lines(spark, path)


def metrics_source(spark: SparkSession, d: str) -> DataFrame:
    """One row of label counts as JSON."""
    path = _folder(spark)
    pairs.write_metrics(table(spark, d, "labels").agg(
        F.count("*").alias("n"), F.sum("quality").alias("good"), F.sum("toxic").alias("bad")), path)
    return spark.read.schema("n bigint, good bigint, bad bigint").json(path)


def dump_source(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of every document as JSON lines."""
    path = _folder(spark)
    corpus.write_token_dump(token_dump(table(spark, d, "documents"), "doc_id", {"text": "standard"}), path)
    return spark.read.schema("doc_id bigint, text_tokens array<string>").json(path).select(
        "doc_id", F.array_join("text_tokens", " ").alias("tokens"))


QUERIES = {"source_csv": csv_source, "source_csv_parts": csv_parts, "source_csv_lines": csv_lines, "source_csv_parquet": csv_as_parquet,
           "source_keyed": keyed_source, "source_pair_lines": pair_source, "source_metrics": metrics_source,
           "source_token_dump": dump_source}

ORACLE = {
    "source_csv": "select doc_id::varchar as doc_id, text, lang, source from documents",
    "source_csv_parts": "select doc_id::varchar as doc_id, text, lang, source from documents",
    "source_csv_lines": "select event_id, user_id from events",
    "source_csv_parquet": "select doc_id, text from documents",
    "source_keyed": "select source, lang, doc_id, text from documents qualify row_number() over (partition by source, lang order by doc_id desc) = 1",
    "source_pair_lines": "select source || ' ' || doc_id as \"left\", split_part(text, chr(10), 1) as \"right\", (doc_id % 2)::int as label from documents",
    "source_metrics": "select count(*) as n, sum(quality)::bigint as good, sum(toxic)::bigint as bad from labels",
    "source_token_dump": f"select doc_id, array_to_string(regexp_extract_all(lower(text), {STANDARD}), ' ') as tokens from documents",
}
