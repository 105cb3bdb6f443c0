"""Documents to packed training sequences, in stages that are each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslink.llm import contamination, language, line_templates, simhash
from corpuslink.llm import queries as q
from corpuslink.operators.scale import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a letter, and those the model is not sure of, go."""
    found = language.identify_languages(docs, language.fit_languages(docs), keep=COLUMNS)
    return found.where("accepted").select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: recurring lines go, documents stay, if need be with an empty text."""
    lines = line_templates.drop_recurring_lines(docs, keep=("lang", "source"))
    return lines.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (three-word shingles, two bits): of each component, the row of the smallest id and text stays.

    Ids can repeat or be null, so that rows are told apart by id and text; of rows equal in
    both, one stays. Null ids come after all others.
    """
    digest = F.xxhash64("text").alias("digest")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", digest).alias("key")
    found = simhash.near_duplicates(docs.select(key, "text"), "key", width=3, radius=2)
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "digest")
    first = found.where("doc_id <=> component_id").select("doc_id.*").select(name.alias("name")).distinct()
    rows = docs.withColumn("digest", digest).withColumn("name", name)
    kept = rows.join(first.hint("merge"), "name", "left_semi")  # a merge join at any size; the ranks keep its partitions
    again = Window.partitionBy("name").orderBy("lang", "source", "n_chars")
    return kept.withColumn("again", F.row_number().over(again)).where("again = 1").select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold four fifths of an item go."""
    found = contamination.contained_items(docs, q.table(spark, sf_dir, "benchmark"))
    leaks = found.select(F.col("doc_id").alias("leak")).distinct()
    return docs.join(leaks.hint("merge"), docs["doc_id"].eqNullSafe(F.col("leak")), "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left."""
    return q.packed_documents(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}

#: Language models, fingerprints and tokenizers have no form in SQL.
ORACLE_SQL = None
ORACLE: dict[str, str] = {}
