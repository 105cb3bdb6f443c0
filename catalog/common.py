"""Shared inputs and SQL fragments of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslink.functions import analysis

TABLES = ("documents", "pages", "conversations", "labels", "part", "events")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def run_sql(spark: SparkSession, d: str, text: str) -> DataFrame:
    """SQL over the given tables; the same text serves the other engine."""
    for name in TABLES:
        if name in text:
            table(spark, d, name).createOrReplaceTempView(name)
    return spark.sql(text)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STANDARD = quote(analysis.STANDARD)
WORDS2 = quote(analysis.TWO_LETTERS)
SPACE = r"'[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'"


def clean(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c},''), {SPACE}, ' ', 'g'))"


def quantized(dl: str) -> str:
    over = f"greatest({dl}-24,16)"
    shift = f"(length(bin({over}))-4)"
    return f"(case when {dl}<40 then {dl} else 24+((({over}) >> {shift}) << {shift}) end)"


def idf_sql(n: str, df: str) -> str:
    return f"ln(1+({n}-{df}+0.5)/({df}+0.5))"


def bm25_sql(tf: str, df: str, n: str, dl: str, avgdl: str) -> str:
    return (f"({idf_sql(n, df)}*2.2*{tf}/({tf}+1.2*(0.25+0.75*{quantized(dl)}/{avgdl})))")


def terms_sql(source: str = "documents", ident: str = "doc_id", text: str = "text",
              name: str = "tok", stops: tuple[str, ...] = ()) -> str:
    """CTEs: <name>(doc_id, term, pos) and the length and statistics tables."""
    words = f"regexp_extract_all(lower({text}), {STANDARD})"
    if stops:
        words = f"list_filter({words}, lambda x: not list_contains([{', '.join(map(quote, stops))}], x))"
    return f"""{name}_l as (select {ident} as doc_id, {words} as l from {source}),
{name} as (select doc_id, unnest(l) as term, generate_subscripts(l,1)-1 as pos from {name}_l),
{name}_dl as (select doc_id, len(l) as dl from {name}_l where len(l)>0),
{name}_st as (select count(*) as n, sum(dl)/count(*) as avgdl from {name}_dl),
{name}_tf as (select doc_id, term, count(*) as tf from {name} group by all),
{name}_df as (select term, count(*) as df from {name}_tf group by term),
{name}_sc as (select doc_id, term, tf, df, n, dl, avgdl, {bm25_sql('tf', 'df', 'n', 'dl', 'avgdl')} as score
  from {name}_tf join {name}_df using(term) join {name}_dl using(doc_id), {name}_st)"""
