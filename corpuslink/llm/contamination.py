"""Benchmark decontamination by containment MinHash, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.operators.scale import materialize

#: Index rows up to which a broadcast is asked for: 16 bytes each, 16 MB at most.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and marks; punctuation parts words and is left out."""
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}\\p{M}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def runs(words: Column, width: int, name) -> Column:
    """`name(words of a run)` of every run of `width` words; of all words if they are fewer."""
    every = F.transform(F.sequence(F.lit(0), F.size(words) - width),
                        lambda i: name(*[F.get(words, i + k) for k in range(width)]))
    alone = F.array(name(*[F.get(words, F.lit(k)) for k in range(width)]))
    return F.when(F.size(words) >= width, every).when(F.size(words) > 0, alone)


def spelt(*run: Column) -> Column:
    return F.concat_ws(" ", *run)


def bounded(df: DataFrame) -> DataFrame:
    """A broadcast hint if the written frame is counted to be small; else Spark decides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", width: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """Items of which a document holds the share `threshold` of the word shingles or more.

    Items are partitioned by size, in classes of powers of two. An item of n different
    shingles is sketched by its MinHash values: its s = n - ceil(threshold n) + 1
    smallest hashes. A document that holds the wanted share lacks fewer than s
    shingles, so it holds one of the sketch, however long the document is. A document
    is a candidate only for classes that it has enough shingles for. Candidates are
    verified: the shingles that they share, word by word, are counted.

    Returns doc_id, item_id, n_shared, n_item and containment, one row per document id
    and item. Each row is a document; of rows with one id the one that holds most of the
    item is reported. Words are lower-cased runs of letters and digits. A text of fewer
    words than `width` is one shingle of all its words; null, empty and wordless texts
    hold nothing and are contained in nothing. Null is an id like any other. Rows of
    items with one id are one item. Empty tables give no rows.
    """
    need = F.ceil(F.col("n_item") * threshold - 1e-9)
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), words(F.col(f"`{item_text_col}`")).alias("words"))
    asked = asked.select("item_id", F.explode_outer(runs(F.col("words"), width, F.struct)).alias("run")).select(
        "item_id", F.xxhash64("run.*").alias("hash"), F.concat_ws(" ", "run.*").alias("shingle"))
    asked = materialize(asked.where("shingle != ''").distinct())
    sizes = asked.groupBy("item_id").agg(F.array_sort(F.collect_set("hash")).alias("hashes"),
                                         F.count("*").alias("n_item")).withColumn("need", need)
    classes = sizes.groupBy(F.floor(F.log2("n_item")).alias("size_class")).agg(F.min("need").alias("class_need"))
    sizes = sizes.withColumn("size_class", F.floor(F.log2("n_item"))).join(F.broadcast(classes), "size_class")
    sketch = F.slice("hashes", F.lit(1), (F.col("n_item") - F.col("need") + 1).cast("int"))
    index = materialize(sizes.select("item_id", "class_need", F.explode(sketch).alias("hash")))

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                         F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("row"))
    # The outer explode gives a null for a text without words; no join keeps it. With a
    # plain one, or a size that can be null, the optimizer would test the array first and
    # so work it out twice.
    probe = source.select("row", words(F.col("text")).alias("words"))
    probe = probe.select("row", runs(F.col("words"), width, F.xxhash64).alias("hashes"))
    probe = probe.select("row", F.coalesce(F.size("hashes"), F.lit(0)).alias("n_doc"), F.explode_outer("hashes").alias("hash"))
    hits = probe.join(bounded(index), "hash").where(F.col("n_doc") >= F.col("class_need"))
    pairs = materialize(hits.select("row", "item_id").distinct())

    chosen = source.join(pairs.select("row").distinct(), "row", "left_semi").select(
        "doc_id", "row", words(F.col("text")).alias("words"))
    held = chosen.select("doc_id", "row", F.explode_outer(runs(F.col("words"), width, spelt)).alias("shingle")).distinct()
    found = held.join(bounded(asked.select("item_id", "shingle")), "shingle")
    wanted = pairs.select(F.col("row").alias("at"), F.col("item_id").alias("item"))
    found = found.join(wanted, (F.col("row") == F.col("at")) & F.col("item_id").eqNullSafe(F.col("item")), "left_semi")
    counted = found.groupBy("doc_id", "row", "item_id").agg(F.count("*").alias("c"))
    counted = counted.groupBy("doc_id", "item_id").agg(F.max("c").alias("n_shared"))
    total = sizes.select(F.col("item_id").alias("item"), "n_item", "need")
    return counted.join(total, F.col("item_id").eqNullSafe(F.col("item"))).where(
        F.col("n_shared") >= F.col("need")).select(
        "doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
