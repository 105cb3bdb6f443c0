"""Record sources in CSV and keyed tables in Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import upsert_last
from ..operators.mediation import read_matching
from ..operators.scale import dense_rank_index, materialize

CSV_OPTIONS = {"header": True, "escape": '"'}


def read_csv_source(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                    schema: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with quoted text; all columns are text unless a schema is given.

    Text that goes over several lines is read with `multi_line`, one task per file.
    Large files of that kind are read by many tasks with `read_csv_parts`; files
    with one record per line are read in parts with `multi_line=False`.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*columns) if columns else df


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files whose quoted texts go over lines: file, record (from 0) and its text.

    Byte ranges of a file are read by lines in separate tasks. A line begins a record if
    an even number of quotes stands before it in its file; that number is counted inside
    each range and added up over the ranges, and so are the records. Lines of one record
    are then put together, also across ranges. Quotes stand around values only and are
    doubled inside them. Lines end with LF or CR LF; line ends inside a value stay as they are.
    Blank lines between records are left out.
    """
    lines = materialize(spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"')))).alias("quotes")))
    order, keys = [F.col("line")], ["file"]
    counted = dense_rank_index(lines, F.col("range"), order, keys, "before", weight="quotes")
    begins = ((F.col("before") % 2 == 0) & ~F.col("value").isin("", "\r")).cast("int")
    blank = (F.col("before") % 2 == 0) & F.col("value").isin("", "\r")
    marked = materialize(counted.withColumn("begins", begins).where(~blank).select(
        "file", "range", "line", "value", "begins"))
    # Records that began before a line, and the line itself if it begins one.
    numbered = dense_rank_index(marked, F.col("range"), order, keys, "earlier", weight="begins")
    record = (F.col("earlier") + F.col("begins") - 1).alias("record")
    parts = F.array_sort(F.collect_list(F.struct("range", "line", "value")))
    text = F.array_join(F.transform(parts, lambda x: x["value"]), "\n")
    return numbered.groupBy("file", record).agg(F.regexp_replace(text, "\\r$", "").alias("text"))


def read_csv_parts(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   schema: str | None = None) -> DataFrame:
    """The rows of `read_csv_source` with `multi_line`, read by many tasks whatever the size of a file.

    Each file begins with the same header. No row is held to be in the order of its file.
    """
    if schema is None:
        names = read_csv_source(spark, path).columns
        schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = csv_records(spark, path).where("record > 0")
    options = {"escape": CSV_OPTIONS["escape"], "multiLine": "true"}
    df = rows.select(F.from_csv("text", schema, options).alias("r")).select("r.*")
    return df.select(*columns) if columns else df


def csv_to_parquet(spark: SparkSession, path: str, target: str, schema: str | None = None,
                   in_parts: bool = False) -> DataFrame:
    """Convert CSV sources once and for all; the result is read in parts and by column."""
    read = read_csv_parts if in_parts else read_csv_source
    read(spark, path, schema=schema).write.parquet(target)
    return spark.read.parquet(target)


def read_matching_csv(spark: SparkSession, path: str, keys: DataFrame | None, mapping: Mapping[str, str],
                      schema: str | None = None, in_parts: bool = False) -> DataFrame:
    """CSV rows with a known make and year whose key is in `keys`."""
    read = read_csv_parts if in_parts else read_csv_source
    return read_matching(read(spark, path, schema=schema), keys, mapping)


def write_sources(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write one built source so that `read_csv_source` reads it back unchanged."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(header=True, escape='"', quoteAll=True).csv(path)
    else:
        writer.format(fmt).save(path)


def document_key(df: DataFrame, *columns: str) -> DataFrame:
    """Adds `_id`: the key columns joined by an underscore."""
    return df.withColumn("_id", F.concat_ws("_", *columns))


def write_keyed(df: DataFrame, keys: Sequence[str], path: str, order: Sequence[str],
                keep_all: bool = False) -> None:
    """Write rows by key: the last row of a key in `order` wins, or every row is kept."""
    rows = df if keep_all else upsert_last(df, keys, order)
    rows.write.mode("overwrite").parquet(path)
