"""Paper rows from landed feeds, and how media rows relate to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.markup import article_parts, visible_text
from ..functions.text import (FEED_A, FEED_B, article_id, article_url, author_names, clean_text,
                              html_url, last_segment, publication_date, safe_title)
from .scale import spread

# Smallest accepted page of either feed, in bytes.
MIN_BYTES = {FEED_A: 2000, FEED_B: 4000}
PAPER = ["source", "document_id", "title", "authors", "date", "abstract", "full_text", "pdf_url",
         "local_file_saved", "local_filename"]


def html_to_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Adds the visible text of each page with white space collapsed."""
    return pages.withColumn(name, clean_text(visible_text(F.col(html))))


def attach_html(meta: DataFrame, pages: DataFrame, key: str = "file_id") -> DataFrame:
    """Metadata with the landed page of the same id; null when there is none."""
    return meta.join(pages.select(F.col("paper_id").alias(key), "html"), key, "left")


def build_papers(meta: DataFrame, pages: DataFrame) -> DataFrame:
    """First feed: (entry_id, title, authors, published, summary) and pages to papers.

    Without a page that is large enough the summary serves as full text.
    """
    large = pages.where(F.octet_length("html") > MIN_BYTES[FEED_A])
    known = meta.withColumn("document_id", last_segment(F.col("entry_id"))).withColumn(
        "file_id", safe_title(F.col("document_id")))
    joined = attach_html(known, large)
    saved = F.col("html").isNotNull()
    return joined.select(
        F.lit(FEED_A).alias("source"), "document_id", "title", "authors",
        F.col("published").alias("date"), F.col("summary").alias("abstract"),
        F.when(saved, clean_text(visible_text(F.col("html")))).otherwise(F.col("summary")).alias("full_text"),
        html_url(F.col("entry_id")).alias("pdf_url"), saved.alias("local_file_saved"),
        F.when(saved, F.concat("file_id", F.lit(".html"))).alias("local_filename"))


def parse_article_xml(df: DataFrame, xml: str, id_col: str, pages: DataFrame | None = None,
                      keep_malformed: bool = False) -> DataFrame:
    """Second feed: article XML to papers; broken XML is left out or kept with
    its `status`."""
    parts = spread(df, id_col).select(F.col(id_col).alias("article"), article_parts(F.col(xml)).alias("x"))
    if not keep_malformed:
        parts = parts.where("x.status = 'ok'")
    name = article_id(F.col("article"))
    rows = parts.withColumn("document_id", name)
    if pages is not None:
        large = pages.where(F.octet_length("html") > MIN_BYTES[FEED_B])
        rows = rows.join(large.select(F.col("paper_id").alias("document_id"),
                                      F.lit(True).alias("saved")), "document_id", "left")
    else:
        rows = rows.withColumn("saved", F.lit(None).cast("boolean"))
    saved = F.coalesce("saved", F.lit(False))
    title = F.col("x.title")
    papers = rows.select(
        F.lit(FEED_B).alias("source"), "document_id",
        F.when(title != "", title).otherwise("Title Unknown").alias("title"),
        author_names(F.col("x.contribs")).alias("authors"),
        publication_date(F.col("x.dates")).alias("date"),
        clean_text(F.col("x.abstract")).alias("abstract"), clean_text(F.col("x.body")).alias("full_text"),
        article_url(F.col("article")).alias("pdf_url"), saved.alias("local_file_saved"),
        F.when(saved, F.concat("document_id", F.lit(".html"))).alias("local_filename"),
        F.col("x.status").alias("status"))
    return papers if keep_malformed else papers.drop("status")


def union_papers(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*PAPER).unionByName(b.select(*PAPER))


def with_parent(media: DataFrame, papers: DataFrame) -> DataFrame:
    """Media rows with `parent_title` and `parent_found`."""
    parents = papers.select(F.col("document_id").alias("paper_id"), F.col("title").alias("parent_title"),
                            F.lit(True).alias("parent_found"))
    return media.join(parents, "paper_id", "left").withColumn(
        "parent_found", F.coalesce("parent_found", F.lit(False)))


def orphans(media: DataFrame, papers: DataFrame) -> DataFrame:
    """Media rows whose paper is missing."""
    return media.join(papers.select(F.col("document_id").alias("paper_id")), "paper_id", "left_anti")


def with_child_counts(papers: DataFrame, **children: DataFrame) -> DataFrame:
    """Papers with `n_<name>` rows of each child table."""
    for name, child in children.items():
        counts = child.groupBy(F.col("paper_id").alias("document_id")).agg(
            F.count(F.lit(1)).alias(f"n_{name}"))
        papers = papers.join(counts, "document_id", "left").withColumn(
            f"n_{name}", F.coalesce(f"n_{name}", F.lit(0).cast("bigint")))
    return papers
