"""Paragraphs, figures and tables of pages, with mentions and context."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.markup import html_elements
from ..functions.text import FEED_A, FEED_B, clean_text, compose_caption, image_url
from .scale import materialize, spread
from .tfidf import MIN_PARAGRAPHS, THRESHOLD, cosine_pairs

KEYS = ["source", "paper_id"]
MIN_LENGTH = 50
UNKNOWN = "unknown"


def elements(pages: DataFrame) -> DataFrame:
    """Elements of (source, paper_id, html) pages; every later step reads this."""
    return html_elements(spread(pages, *KEYS), KEYS)


def paragraphs(els: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Paragraphs longer than `min_length` raw characters, numbered per paper."""
    w = Window.partitionBy(*KEYS).orderBy("node")
    return (els.where((F.col("tag") == "p") & (F.length("text") > min_length))
            .withColumn("para_idx", F.row_number().over(w) - 1)
            .select(*KEYS, "node", "para_idx", F.col("text").alias("raw"),
                    clean_text(F.col("text")).alias("text")))


def paragraph_links(els: DataFrame, paras: DataFrame) -> DataFrame:
    """(source, paper_id, para_idx, href) of the links inside paragraphs."""
    links = (els.where((F.col("tag") == "a") & F.col("href").isNotNull())
             .select(*KEYS, "href", F.explode("path").alias("up"))
             .where("up.tag = 'p'").select(*KEYS, F.col("up.node").alias("node"), "href"))
    return links.join(paras.select(*KEYS, "node", "para_idx"), [*KEYS, "node"]).select(
        *KEYS, "para_idx", "href")


def extract_paragraphs(pages: DataFrame) -> DataFrame:
    """Paragraphs of pages with the array of their links."""
    els = materialize(elements(pages))
    paras = paragraphs(els)
    links = paragraph_links(els, paras).groupBy(*KEYS, "para_idx").agg(
        F.sort_array(F.collect_list("href")).alias("hrefs"))
    return (paras.join(links, [*KEYS, "para_idx"], "left")
            .withColumn("hrefs", F.coalesce("hrefs", F.array().cast("array<string>")))
            .drop("node"))


def _has(cls: Column, token: str) -> Column:
    return F.array_contains(F.split(cls, " "), token)


def _first(condition: Column, value: Column) -> Column:
    """Value of the first element, in document order, that meets the condition."""
    return F.min(F.when(condition, F.struct(F.col("node"), value.alias("v"))))["v"]


def _containers(els: DataFrame, is_container, extra: list[Column]) -> DataFrame:
    """One row per container element with aggregates over all it encloses."""
    inside = (els.withColumn("up", F.explode("path"))
              .where(is_container(F.col("up.tag"), F.col("up.cls"))))
    own = F.col("node") == F.col("up.node")
    return (inside.groupBy(*KEYS, F.col("up.node").alias("obj_node"))
            .agg(F.max(F.when(own, F.col("id"))).alias("id"),
                 F.max(F.when(own, F.col("cls"))).alias("cls"),
                 F.max(F.when(own, F.col("path"))).alias("path"), *extra)
            .withColumn("id", F.when(F.col("id") != "", F.col("id")).otherwise(UNKNOWN)))


def _joined(condition: Column) -> Column:
    """Cleaned texts of all matching elements in document order."""
    items = F.sort_array(F.collect_list(F.when(
        condition, F.struct(F.col("node"), clean_text(F.col("text")).alias("v")))))
    return F.array_join(F.transform(items, lambda x: x["v"]), " ")


def figures_a(els: DataFrame, only_nested: bool = False) -> DataFrame:
    """First feed: sub-figures of each top-level figure, and by default also
    figures without sub-figures."""
    is_fig = lambda tag, cls: (tag == "figure") & _has(cls, "ltx_figure")
    figs = lambda path: F.filter(path, lambda p: is_fig(p["tag"], p["cls"]))
    caption = F.col("tag") == "figcaption"
    nearest = F.element_at(figs(F.col("path")), -1)["node"]
    boxes = _containers(els, is_fig, [
        _joined(caption).alias("all_captions"),
        _joined(caption & (nearest == F.col("up.node"))).alias("own_captions"),
        _first(F.col("tag") == "img", F.col("src")).alias("img_src")])
    boxes = boxes.withColumn("figs", figs(F.col("path")))
    tops = boxes.where((F.size("figs") == 1) & ~F.contains(F.col("cls"), F.lit("ltx_table"))).select(
        *KEYS, F.col("obj_node").alias("top"), F.col("id").alias("parent_id"),
        F.col("own_captions").alias("main"))
    subs = (boxes.where(F.size("figs") > 1).withColumn("top", F.col("figs")[0]["node"])
            .join(tops, [*KEYS, "top"])
            .withColumn("caption", compose_caption(F.col("all_captions"), F.col("main"), F.lit(FEED_A))))
    if not only_nested:
        nested = subs.select(*KEYS, F.col("top").alias("obj_node")).distinct()
        plain = (boxes.where((F.size("figs") == 1) & ~F.contains(F.col("cls"), F.lit("ltx_table")))
                 .join(nested, [*KEYS, "obj_node"], "left_anti")
                 .withColumn("parent_id", F.col("id")).withColumn("caption", F.col("all_captions")))
        subs = subs.select(*plain.columns).unionByName(plain)
    base = (els.where("tag = 'base'").groupBy(*KEYS)
            .agg(F.min(F.struct("node", F.coalesce("href", F.lit("")).alias("v")))["v"].alias("base_href")))
    src = F.coalesce("img_src", F.lit(""))
    return (subs.join(base, KEYS, "left").select(
        *KEYS, "obj_node", F.col("id").alias("object_id"), "parent_id",
        image_url(src, F.col("base_href"), F.lit(FEED_A)).alias("img_url"), src.alias("local_src"),
        "caption", F.lit("").alias("body_content"), F.lit("figure").alias("kind")))


def tables_a(els: DataFrame) -> DataFrame:
    """First feed: `figure.ltx_table` with its first caption and table."""
    boxes = _containers(els, lambda tag, cls: (tag == "figure") & _has(cls, "ltx_table"), [
        _first(F.col("tag") == "figcaption", F.col("text")).alias("cap"),
        _first(F.col("tag") == "table", F.col("spaced")).alias("body")])
    return _tables(boxes, clean_text(F.col("cap")))


def _label() -> Column:
    head = F.col("tag").isin("h3", "h4", "strong") & _has(F.col("cls"), "obj_head")
    return _first(head, F.col("text"))


def _tables(boxes: DataFrame, caption: Column) -> DataFrame:
    out = boxes.select(
        *KEYS, "obj_node", F.col("id").alias("object_id"), F.col("id").alias("parent_id"),
        F.lit("").alias("img_url"), F.lit("").alias("local_src"), caption.alias("caption"),
        clean_text(F.col("body")).alias("body_content"), F.lit("table").alias("kind"))
    return nonempty_media(out)


def figures_b(els: DataFrame) -> DataFrame:
    """Second feed: every figure without a table."""
    boxes = _containers(els, lambda tag, cls: tag == "figure", [
        _first(F.col("tag") == "figcaption", F.col("text")).alias("cap"), _label().alias("label"),
        _first(F.col("tag") == "img", F.col("src")).alias("img_src"),
        F.count_if(F.col("tag") == "table").alias("n_tables")])
    src = F.coalesce("img_src", F.lit(""))
    out = boxes.where(~F.contains(F.col("cls"), F.lit("table")) & (F.col("n_tables") == 0)).select(
        *KEYS, "obj_node", F.col("id").alias("object_id"), F.col("id").alias("parent_id"),
        image_url(src, F.lit(""), F.lit(FEED_B)).alias("img_url"), src.alias("local_src"),
        compose_caption(clean_text(F.col("label")), clean_text(F.col("cap")), F.lit(FEED_B)).alias("caption"),
        F.lit("").alias("body_content"), F.lit("figure").alias("kind"))
    return nonempty_media(out)


def tables_b(els: DataFrame) -> DataFrame:
    """Second feed: div or section with a class token containing table-wrap or tw."""
    wrapped = lambda tag, cls: tag.isin("div", "section") & F.exists(
        F.split(cls, " "), lambda t: F.contains(t, F.lit("table-wrap")) | F.contains(t, F.lit("tw")))
    other = F.col("node") != F.col("up.node")
    boxes = _containers(els, wrapped, [
        _first(_has(F.col("cls"), "caption") & other, F.col("text")).alias("cap"),
        _label().alias("label"), _first(F.col("tag") == "table", F.col("spaced")).alias("body")])
    return _tables(boxes, compose_caption(
        clean_text(F.col("label")), clean_text(F.col("cap")), F.lit(FEED_B)))


def nonempty_media(objects: DataFrame) -> DataFrame:
    """Drop objects without caption, body or image."""
    return objects.where((F.col("caption") != "") | (F.col("body_content") != "") | (F.col("img_url") != ""))


def media_objects(els: DataFrame, only_nested: bool = False) -> DataFrame:
    """Figures and tables of both feeds in one frame."""
    a, b = els.where(F.col("source") == FEED_A), els.where(F.col("source") == FEED_B)
    return reduce(DataFrame.unionByName, [figures_a(a, only_nested), tables_a(a), figures_b(b), tables_b(b)])


OBJECT = [*KEYS, "kind", "obj_node"]


def mentions(objects: DataFrame, links: DataFrame) -> DataFrame:
    """(object, para_idx, via): paragraphs with a link to the object or, as
    `via` 0, to its parent; each paragraph once per target."""
    targets = objects.select(*OBJECT, F.explode(F.array_distinct(F.array(
        F.col("parent_id"), F.col("object_id")))).alias("anchor"), "parent_id")
    anchored = (links.where(F.contains("href", F.lit("#")))
                .select(*KEYS, "para_idx", F.substring_index("href", "#", -1).alias("anchor")).distinct())
    return (targets.join(anchored, [*KEYS, "anchor"])
            .select(*OBJECT, "para_idx", (F.col("anchor") != F.col("parent_id")).cast("int").alias("via")))


def context(objects: DataFrame, paras: DataFrame, mentioned: DataFrame, threshold: float = THRESHOLD,
            min_paragraphs: int = MIN_PARAGRAPHS, stop_words: Iterable[str] | None = None) -> DataFrame:
    """(object, para_idx) of similar paragraphs that do not mention the object."""
    text = F.when(F.col("kind") == "table", F.concat("caption", F.lit(" "), "body_content")).otherwise(
        F.col("caption"))
    group = F.struct(*KEYS).alias("paper")
    objs = objects.select(group, F.struct("kind", "obj_node").alias("obj"), text.alias("text"))
    found = cosine_pairs(objs, paras.select(group, "para_idx", "text"), "paper", "obj", "para_idx",
                         threshold, min_paragraphs, stop_words=stop_words)
    found = found.select("paper.*", "obj.*", "para_idx", "cosine")
    return found.join(mentioned.select(*OBJECT, "para_idx").distinct(), [*OBJECT, "para_idx"], "left_anti")


def collect_paragraphs(rows: DataFrame, paras: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Paragraph texts of each object as an ordered array."""
    texts = rows.join(paras.select(*KEYS, "para_idx", "text"), [*KEYS, "para_idx"])
    items = F.sort_array(F.collect_list(F.struct(*order, "text")))
    return texts.groupBy(*OBJECT).agg(F.transform(items, lambda x: x["text"]).alias(name))


def with_paragraphs(objects: DataFrame, paras: DataFrame, links: DataFrame,
                    threshold: float = THRESHOLD, stop_words: Iterable[str] | None = None,
                    distinct: bool | None = None) -> DataFrame:
    """Objects with `mentions` and `context_paragraphs`.

    Equal mention texts are kept once for figures of the first feed only, or
    everywhere (nowhere) when `distinct` is true (false).
    """
    found = mentions(objects, links)
    m = collect_paragraphs(found, paras, "mentions", ["via", "para_idx"])
    c = collect_paragraphs(context(objects, paras, found, threshold, stop_words=stop_words),
                           paras, "context_paragraphs", ["para_idx"])
    once = (F.lit(distinct) if distinct is not None
            else (F.col("source") == FEED_A) & (F.col("kind") == "figure"))
    empty = F.array().cast("array<string>")
    return (objects.join(m, OBJECT, "left").join(c, OBJECT, "left")
            .withColumn("mentions", F.coalesce(
                F.when(once, F.array_distinct("mentions")).otherwise(F.col("mentions")), empty))
            .withColumn("context_paragraphs", F.coalesce("context_paragraphs", empty)))


def extract_media(pages: DataFrame, only_nested: bool = False, threshold: float = THRESHOLD,
                  stop_words: Iterable[str] | None = None) -> DataFrame:
    """Figures and tables of (source, paper_id, html) pages with their paragraphs.

    Elements, paragraphs and objects are each read several times, so they are
    checkpointed: a page is parsed once.
    """
    els = materialize(elements(pages))
    paras = materialize(paragraphs(els).drop("raw"))
    objects = materialize(media_objects(els, only_nested))
    return with_paragraphs(objects, paras, paragraph_links(els, paras), threshold, stop_words)


def figure_rows(objects: DataFrame) -> DataFrame:
    """Figures in their table layout."""
    return objects.where(F.col("kind") == "figure").select(
        *KEYS, F.col("object_id").alias("figure_id"), "obj_node", "img_url", "local_src", "caption",
        "mentions", "context_paragraphs")


def table_rows(objects: DataFrame) -> DataFrame:
    """Tables in their table layout."""
    return objects.where(F.col("kind") == "table").select(
        *KEYS, F.col("object_id").alias("table_id"), "obj_node", "caption", "body_content",
        "mentions", "context_paragraphs")
