"""Inverted lists as a table: who contains which term, how often and where."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.analysis import analyze, analyzed_length, explode_terms, get_analyzer, terms_of_tokens
from .scale import materialize, once_and_again, spread

FieldSpec = str | tuple[str, Sequence[str]]


def _spec(spec: FieldSpec) -> tuple[str, Sequence[str] | None]:
    return (spec, None) if isinstance(spec, str) else spec


@dataclass(frozen=True)
class TermIndex:
    """Postings (field, term, doc_id, tf, positions, dl), field statistics
    (field, n_docs, avgdl, norms) and, once written, the dictionary (field, gram, term)."""

    postings: DataFrame
    stats: DataFrame
    fields: Mapping[str, FieldSpec]
    grams: DataFrame | None = None

    def write(self, path: str) -> None:
        """Write all tables; postings are grouped by field and sorted by term."""
        _write_sorted(self.postings, ["term", "doc_id"], f"{path}/postings")
        _write_grams(self.postings.sparkSession, path)
        self.stats.write.mode("overwrite").parquet(f"{path}/stats")


def read_index(spark: SparkSession, path: str, fields: Mapping[str, FieldSpec]) -> TermIndex:
    return TermIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/stats"), dict(fields),
                     spark.read.schema("gram string, term string, field string").parquet(f"{path}/grams"))


def _write_sorted(df: DataFrame, order: Sequence[str], path: str) -> None:
    """A folder per field, rows in order, so that scans skip what a literal rules out."""
    (df.repartitionByRange("field", *order).sortWithinPartitions("field", *order)
     .write.mode("overwrite").partitionBy("field").parquet(path))


def _write_grams(spark: SparkSession, path: str) -> None:
    terms = spark.read.parquet(f"{path}/postings").select("field", "term").distinct()
    _write_sorted(term_grams(terms), ["gram", "term"], f"{path}/grams")


def grams(c: Column, sizes: Sequence[int]) -> Column:
    """The different runs of so many characters."""
    return F.array_distinct(F.flatten(F.array(*[
        F.when(F.length(c) >= n, F.transform(
            F.sequence(F.lit(1), F.length(c) - n + 1),
            lambda i: F.substring(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
        for n in sizes])))


def term_grams(terms: DataFrame) -> DataFrame:
    """(field, gram, term): grams of up to three characters, and the empty one, of every term."""
    bare = F.array(F.lit(""))  # the gram of patterns without a literal
    return terms.select("field", F.explode(F.concat(bare, grams(F.col("term"), [1, 2, 3]))).alias("gram"), "term")


def occurrences(docs: DataFrame, id_col: str, fields: Mapping[str, FieldSpec]) -> DataFrame:
    """(field, doc_id, dl, term, pos) of every field, one pass per field."""
    docs, parts = spread(docs, id_col), []
    for field, spec in fields.items():
        name, stops = _spec(spec)
        parts.append(explode_terms(docs, id_col, field, name, stops)
                     .select(F.lit(field).alias("field"), "doc_id", "dl", "term", "pos"))
    return reduce(DataFrame.unionByName, parts)


def build_postings(docs: DataFrame, id_col: str, fields: Mapping[str, FieldSpec]) -> DataFrame:
    """(field, term, doc_id) with tf, sorted positions and the field length.

    A document that is one row is grouped inside it, and nothing is exchanged. Rows of
    ids that repeat, and fields with a stemmer in Python, are grouped by term and document
    together, so a term found in a third of all documents is still spread over all tasks.
    """
    inside = {f: s for f, s in fields.items() if not get_analyzer(_spec(s)[0]).arrow}
    outside = {f: s for f, s in fields.items() if f not in inside}
    once, again = once_and_again(docs, id_col) if inside else (docs, None)
    parts = [_row_postings(spread(once, id_col), id_col, f, s) for f, s in inside.items()]
    shuffled = [(docs, outside)] if outside else []
    shuffled += [(again, inside)] if again is not None else []
    parts += [occurrences(rows, id_col, some).groupBy("field", "term", "doc_id").agg(
        F.count(F.lit(1)).alias("tf"),
        F.sort_array(F.collect_list("pos")).alias("positions"),
        F.first("dl").alias("dl")) for rows, some in shuffled]
    return reduce(DataFrame.unionByName, parts)


def _row_postings(docs: DataFrame, id_col: str, field: str, spec: FieldSpec) -> DataFrame:
    """Postings of one field of rows that are a document each.

    The terms of a text are sorted with their positions; a posting is the slice from
    one change of term to the next.
    """
    term = lambda i: F.get("terms", i)["term"]
    n, empty = F.size("terms"), F.array().cast("array<int>")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(empty)
    posting = lambda at, k: F.struct(
        term(at).alias("term"),
        F.slice("places", at + 1, F.coalesce(F.get("starts", k + 1), n) - at).alias("positions"))
    rows = (docs.where(F.col(field).isNotNull())
            .select(F.col(id_col).alias("doc_id"), F.sort_array(analyze(F.col(field), *_spec(spec))).alias("terms"))
            .withColumn("starts", F.filter(places, lambda i: (i == 0) | (term(i) != term(i - 1))))
            .withColumn("places", F.transform("terms", lambda x: x["pos"])))
    # outer: the inner form would cut every text once more in a filter
    return (rows.select("doc_id", n.alias("dl"), F.explode_outer(F.transform("starts", posting)).alias("p"))
            .where("p is not null")
            .select(F.lit(field).alias("field"), "p.term", "doc_id", F.size("p.positions").cast("bigint").alias("tf"),
                    "p.positions", "dl"))


def term_totals(docs: DataFrame, field: str, specs: Sequence[FieldSpec]) -> list[DataFrame]:
    """(term, n) over all texts of a field, one frame for each way to analyse it.

    Tokens are counted first, and a term is made once of each different token. Analysers
    that cut texts alike share the counts.
    """
    counts: dict = {}
    out = []
    for spec in specs:
        name, stops = _spec(spec)
        cut = get_analyzer(name).tokens
        if cut not in counts:
            tokens = spread(docs, field).select(cut(F.col(field)).alias("tokens"))
            counts[cut] = materialize(tokens.select(F.explode_outer("tokens").alias("token")).where("token is not null")
                                      .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
        out.append(terms_of_tokens(counts[cut], "token", name, stops).groupBy("term").agg(F.sum("n").alias("n")))
    return out


def field_stats(docs: DataFrame, id_col: str, fields: Mapping[str, FieldSpec]) -> DataFrame:
    """Documents with at least one term and mean length, per field."""
    lengths = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"),
                 analyzed_length(F.col(f), *_spec(s)).alias("dl"),
                 F.lit(get_analyzer(_spec(s)[0]).norms).alias("norms"))
        for f, s in fields.items()])).alias("x")
    return (spread(docs, id_col).select(lengths).select("x.*").where("dl > 0").groupBy("field", "norms")
            .agg(F.count(F.lit(1)).alias("n_docs"),
                 (F.sum("dl") / F.count(F.lit(1))).alias("avgdl")))


def build_index(docs: DataFrame, id_col: str, fields: Mapping[str, FieldSpec]) -> TermIndex:
    return TermIndex(build_postings(docs, id_col, fields),
                     field_stats(docs, id_col, fields), dict(fields))


def write_index(docs: DataFrame, id_col: str, fields: Mapping[str, FieldSpec], path: str) -> TermIndex:
    """Analyse documents once, write the index and read it back.

    The statistics are those of the written postings, which carry the field lengths. Postings
    are written as they are made and sorted then, as the sample of a sort would make them twice.
    """
    postings = materialize(build_postings(docs, id_col, fields))
    norms = {f: get_analyzer(_spec(s)[0]).norms for f, s in fields.items()}
    _write_sorted(postings, ["term", "doc_id"], f"{path}/postings")
    _write_grams(docs.sparkSession, path)
    lengths = docs.sparkSession.read.parquet(f"{path}/postings").groupBy("field", "doc_id").agg(
        F.first("dl").alias("dl"))
    flags = F.create_map(*[F.lit(x) for f, n in norms.items() for x in (f, n)])
    (lengths.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), (F.sum("dl") / F.count(F.lit(1))).alias("avgdl"))
     .withColumn("norms", flags[F.col("field")]).write.mode("overwrite").parquet(f"{path}/stats"))
    return read_index(docs.sparkSession, path, fields)


def document_frequencies(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(index: TermIndex) -> DataFrame:
    """df of every term beside the statistics of its field."""
    return document_frequencies(index.postings).join(F.broadcast(index.stats), "field")


def token_dump(docs: DataFrame, id_col: str, fields: Mapping[str, FieldSpec]) -> DataFrame:
    """One row per document with the ordered token array of every field."""
    return docs.select(F.col(id_col), *[
        F.transform(analyze(F.col(f), *_spec(s)), lambda t: t["term"]).alias(f"{f}_tokens")
        for f, s in fields.items()])
