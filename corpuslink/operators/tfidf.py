"""TF-IDF inside each paper, and paragraphs that resemble an object."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.analysis import explode_terms
from ..functions.scoring import smooth_idf
from .scale import materialize, spread

THRESHOLD = 0.15
MIN_PARAGRAPHS = 3


def term_counts(texts: DataFrame, group: str, unit: str, text: str = "text",
                analyzer: str = "tfidf_en", stop_words: Iterable[str] | None = None) -> DataFrame:
    """(group, unit, term, tf) of every text."""
    keyed = spread(texts, group, unit).withColumn("__key", F.struct(group, unit))
    return (explode_terms(keyed, "__key", text, analyzer, stop_words)
            .groupBy(F.col(f"doc_id.{group}").alias(group), F.col(f"doc_id.{unit}").alias(unit), "term")
            .agg(F.count(F.lit(1)).alias("tf")))


def vocabulary(counts: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """(group, term, idf) fitted on the group's own texts."""
    df = counts.groupBy(group, "term").agg(F.count(F.lit(1)).alias("df"))
    return df.join(sizes, group).select(group, "term", smooth_idf(F.col("n"), F.col("df")).alias("idf"))


def weights(counts: DataFrame, vocab: DataFrame, group: str, unit: Sequence[str]) -> DataFrame:
    """(group, unit, term, weight) with unit length 1; unknown terms are dropped.

    The length is summed over one text at a time, which is never a large window.
    """
    raw = counts.join(vocab, [group, "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(group, *unit)))
    return raw.select(group, *unit, "term", (F.col("w") / norm).alias("weight"))


#: Characters of the texts that a task takes, and of a group beyond which it is spread over its terms.
TASK_CHARS, LARGE_GROUP = 1 << 25, 1 << 24


def by_group(texts: DataFrame, group: str) -> tuple[DataFrame, DataFrame | None]:
    """Texts with each group in one task, counted so that tasks stay small, and the texts of large groups, if any."""
    sizes = texts.groupBy(F.col(group).alias("__group")).agg(
        F.coalesce(F.sum(F.length("text").cast("bigint")), F.lit(0)).alias("__size"))
    total, largest = sizes.agg(F.sum("__size"), F.max("__size")).first()
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total or 0) // TASK_CHARS + 1)
    if (largest or 0) <= LARGE_GROUP:
        return texts.repartition(parts, group), None
    large = F.broadcast(sizes.where(F.col("__size") > LARGE_GROUP).select("__group"))  # at most total / LARGE_GROUP
    same = F.col(group).eqNullSafe(F.col("__group"))
    return texts.join(large, same, "left_anti").repartition(parts, group), texts.join(large, same, "left_semi")


def weights_together(texts: DataFrame, group: str, unit: str, fits: Column, n_texts: Column, min_texts: int,
                     analyzer: str, stop_words: Iterable[str] | None) -> DataFrame:
    """(group, unit, term, weight, shared) of texts that have each group in one task, without an exchange.

    `fits` tells the units whose terms are the vocabulary, `n_texts` counts a group's texts;
    `shared` says that some unit that does not fit holds the term as well.
    """
    texts = texts.withColumnRenamed(unit, "__unit")
    sized = texts.where(F.col(group).isNotNull()).withColumn("__n", n_texts.over(Window.partitionBy(group)))
    terms = explode_terms(sized.where(F.col("__n") >= min_texts), group, "text", analyzer, stop_words,
                          keep=["__unit", "__n"]).withColumnsRenamed({"doc_id": group, "__unit": unit})
    counts = terms.groupBy(group, unit, "term", "__n").agg(F.count(F.lit(1)).alias("tf"))
    same_term = Window.partitionBy(group, "term")
    raw = (counts.withColumn("__df", F.count_if(fits).over(same_term))
           .withColumn("shared", F.count_if(~fits).over(same_term) > 0).where("__df > 0")
           .withColumn("w", F.col("tf") * smooth_idf(F.col("__n"), F.col("__df"))))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(group, unit)))
    return raw.select(group, unit, "term", (F.col("w") / norm).alias("weight"), "shared")


def tfidf(texts: DataFrame, group: str, unit: str, text: str = "text",
          analyzer: str = "tfidf_en", stop_words: Iterable[str] | None = None,
          min_texts: int = 1) -> DataFrame:
    """Normalised weights of all texts, per group.

    Only the texts are exchanged, by group; large groups are spread over their terms.
    """
    together, large = by_group(texts.select(group, unit, F.col(text).alias("text")), group)
    out = weights_together(together, group, unit, F.lit(True), F.count(F.lit(1)), min_texts, analyzer,
                           stop_words).drop("shared")
    if large is None:
        return out
    sizes = large.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_texts)
    counts = term_counts(large, group, unit, "text", analyzer, stop_words)
    return out.unionByName(weights(counts, vocabulary(counts, group, sizes), group, [unit]))


def cosine_pairs(objects: DataFrame, paragraphs: DataFrame, group: str, object_id: str,
                 para_id: str, threshold: float = THRESHOLD, min_paragraphs: int = MIN_PARAGRAPHS,
                 analyzer: str = "tfidf_en", stop_words: Iterable[str] | None = None) -> DataFrame:
    """(group, object, paragraph, cosine) strictly above the threshold.

    The vocabulary is that of the paper's paragraphs; papers with fewer than
    `min_paragraphs` have none. A paper is weighed and compared in one task, to which only
    its texts go. In large papers products are joined by paper and term together, so they
    are spread over their terms, and partly added before the shuffle by object and paragraph.
    """
    # Both kinds of text go through one pass; `unit` is a paragraph or an object.
    para = paragraphs.select(group, F.struct(F.col(para_id).alias("p"), F.lit(None).cast(
        objects.schema[object_id].dataType).alias("o")).alias("unit"), "text", F.lit(True).alias("is_para"))
    obj = objects.select(group, F.struct(F.lit(None).cast(
        paragraphs.schema[para_id].dataType).alias("p"), F.col(object_id).alias("o")).alias("unit"), "text",
        F.lit(False).alias("is_para"))
    together, large = by_group(para.unionByName(obj), group)
    fits = F.col("unit.o").isNull()
    both = weights_together(together, group, "unit", fits, F.count_if("is_para"), max(1, min_paragraphs), analyzer,
                            stop_words).where("shared")
    known = F.collect_list(F.when(~fits, F.struct(F.col("unit.o").alias("o"), F.col("weight").alias("q"))))
    met = (both.withColumn("known", known.over(Window.partitionBy(group, "term"))).where(fits)
           .select(group, F.col("unit.p").alias(para_id), F.col("weight").alias("p"), F.explode("known").alias("k"))
           .select(group, F.col("k.o").alias(object_id), para_id, (F.col("k.q") * F.col("p")).alias("product")))
    parts = [met.groupBy(group, object_id, para_id).agg(F.sum("product").alias("cosine"))]
    if large is not None:
        parts.append(_products_by_term(large, group, object_id, para_id, min_paragraphs, analyzer, stop_words))
    return reduce(DataFrame.unionByName, parts).where(F.col("cosine") > threshold)


def _products_by_term(texts: DataFrame, group: str, object_id: str, para_id: str, min_paragraphs: int,
                      analyzer: str, stop_words: Iterable[str] | None) -> DataFrame:
    sizes = texts.where("is_para").groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min_paragraphs)
    counts = term_counts(texts, group, "unit", "text", analyzer, stop_words)
    vocab = vocabulary(counts.where("unit.o is null"), group, sizes)
    both = materialize(weights(counts, vocab, group, ["unit"]))
    wq = both.where("unit.o is not null").select(
        group, "term", F.col("unit.o").alias(object_id), F.col("weight").alias("q"))
    wp = both.where("unit.o is null").select(
        group, "term", F.col("unit.p").alias(para_id), F.col("weight").alias("p"))
    return (wq.join(wp, [group, "term"]).groupBy(group, object_id, para_id)
            .agg(F.sum(F.col("q") * F.col("p")).alias("cosine")))
