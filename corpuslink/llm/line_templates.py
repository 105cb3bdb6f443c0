"""Line deduplication by a log-template tree, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.operators.scale import materialize

SPACES = " \t\x0b\f\r"
FIELD = "<*>"
#: Lines of fewer tokens are taken literally: all their tokens lead, none is a field.
LITERAL = 3
#: Full leaves are looked up by slot, so what is broadcast has at most so many rows of 4 bytes.
SLOTS = 1 << 20


def _any(column: str, parts: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(F.col(column), F.lit(part)) for part in parts])


def split_lines(rows: DataFrame) -> DataFrame:
    return rows.select("row", F.length("text").alias("total"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def with_slot(lines: DataFrame, depth: int) -> DataFrame:
    """Adds `key`, which lines of one leaf have in common, and its slot; it costs far less than the leaf.

    It is the hash of the leading tokens as they stand. Where the parser would change
    these (digits, white space), the key is null and the slot -1: such lines are always parsed.
    """
    lines = lines.withColumn("short", F.substring_index(F.trim("line"), " ", depth))
    changed = _any("short", ("  ", *SPACES[1:], FIELD)) | F.col("short").rlike("[0-9]")
    lines = lines.withColumn("key", F.when(~changed, F.xxhash64("short"))).drop("short")
    return lines.withColumn("slot", F.coalesce(F.pmod("key", F.lit(SLOTS)), F.lit(-1)).cast("int"))


def parsed_lines(lines: DataFrame, depth: int) -> DataFrame:
    """Lines with their leaf of the tree: the count of tokens, then the leading tokens.

    `plain` has the words of a line with one space between them; a word that holds a
    digit is a variable field, except in short lines. Blank lines have no tokens. Each
    step reads only columns of the one before, so that no expression is worked out twice.
    """
    spaced = F.trim(F.when(_any("line", ("  ", *SPACES[1:])), F.regexp_replace("line", f"[{SPACES}]+", " "))
                    .otherwise(F.col("line")))
    lines = lines.select("row", "total", "pos", F.length("line").alias("chars"), spaced.alias("plain"))
    lines = lines.withColumn("n", F.when(F.col("plain") == "", 0).otherwise(
        F.octet_length("plain") + 1 - F.octet_length(F.replace("plain", F.lit(" "), F.lit("")))))
    lines = lines.withColumn("plain", F.when((F.col("n") >= LITERAL) & F.col("plain").rlike("[0-9]"), F.regexp_replace(
        "plain", "[^ ]*[0-9][^ ]*", FIELD)).otherwise(F.col("plain")))
    leading = F.when(F.col("n") < LITERAL, F.col("plain")).otherwise(F.substring_index("plain", " ", depth))
    return lines.withColumn("leaf", F.xxhash64("n", leading))


def templates(lines: DataFrame, constant: float) -> DataFrame:
    """The template of every line of a leaf: its tokens, with fields where the leaf varies.

    A position of a leaf is a field if no token holds it in half of the leaf's lines.
    If fewer than the share `constant` of the positions would stay, the lines of the
    leaf have too little in common, and keep all their tokens.
    """
    votes = lines.select("leaf", "n", F.posexplode("tokens").alias("at", "token"))
    votes = votes.groupBy("leaf", "n", "at", "token").agg(F.count("*").alias("c"))
    varied = (votes.groupBy("leaf", "n", "at").agg(F.max("c").alias("top"), F.sum("c").alias("all"))
              .where(F.col("top") * 2 < F.col("all")))
    fields = materialize(varied.groupBy("leaf", "n").agg(F.collect_set("at").alias("fields"))
                         .where(F.col("n") - F.size("fields") >= F.col("n") * constant)
                         .select("leaf", "fields"))
    joined = lines.join(fields, "leaf", "left")
    general = F.transform("tokens", lambda t, i: F.when(F.array_contains("fields", i), FIELD).otherwise(t))
    shown = F.when(F.col("fields").isNull(), F.col("tokens")).otherwise(general)
    return joined.select("row", "total", "pos", "chars",
                         F.md5(F.concat_ws(" ", F.array_join(shown, " "), "n")).alias("template"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_docs: int = 10, depth: int = 3, constant: float = 0.7,
                         near: float = 0.8, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop the lines whose template recurs in `min_docs` documents or more.

    Lines are parsed into a tree of fixed depth: by their count of tokens, then by
    `depth` leading tokens; words with digits, and positions at which the lines of a
    leaf vary, become fields of the template (see `templates`). Lines of one or two
    tokens have no fields: they go where they recur literally.

    Documents that are copies of each other repeat whole texts, not boilerplate. So
    equal texts count once. Documents of which recurring templates hold more than the
    share `near` of the characters are near copies of others; those with the same
    smallest template (by MD5) among their recurring ones count once. What at least
    `min_docs` such voices hold is dropped from all documents.

    Returns doc_id, text (kept lines, joined by a line feed), n_lines, n_dropped and the
    columns `keep` that are not called so. A null text stays null with 0 lines; an
    empty text is one empty line. Blank lines are kept. A text that loses all lines
    becomes empty; no row is dropped. Rows equal in id and text count as one document and
    are treated alike. Lines whose leading tokens are not in `min_docs` lines cannot
    recur, and are not parsed.
    """
    row = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    rows = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    lines = with_slot(split_lines(rows), depth)
    full = lines.where(F.col("key").isNotNull()).groupBy("key", "slot").agg(F.count("*").alias("c"))
    full = full.where(F.col("c") >= min_docs).select("slot").distinct()
    full = full.union(docs.sparkSession.range(1).select(F.lit(-1).alias("slot")))
    # Lines of other keys in the same slots come along; they cannot recur often enough.
    some = lines.join(F.broadcast(full), "slot", "left_semi")
    parsed = parsed_lines(some, depth).where(F.col("n") > 0)
    parsed = materialize(parsed.select("row", "total", "pos", "chars", "n", "leaf", F.split("plain", " ").alias("tokens")))
    leaves = parsed.groupBy("leaf").agg(F.count("*").alias("c")).where(F.col("c") >= min_docs).select("leaf")
    found = materialize(templates(parsed.join(materialize(leaves), "leaf", "left_semi"), constant))

    def held(by: DataFrame, one: str) -> DataFrame:
        """Templates that `min_docs` different values of `one` hold."""
        return materialize(by.select(one, "template").distinct().groupBy("template")
                           .agg(F.count("*").alias("c")).where(F.col("c") >= min_docs).select("template"))

    again = found.join(held(found, "row"), "template", "left_semi")
    shares = again.groupBy("row", "total").agg(F.sum("chars").alias("again"), F.min("template").alias("low"))
    texts = docs.select(row.alias("row"), F.xxhash64(F.col(f"`{text_col}`")).cast("string").alias("same")).distinct()
    voices = materialize(shares.join(texts.hint("merge"), "row").select("row", F.when(
        F.col("again") <= F.col("total") * near, F.col("same")).otherwise(F.col("low")).alias("voice")))
    boiler = held(again.join(voices, "row"), "voice")
    drops = materialize(found.join(boiler, "template", "left_semi").groupBy("row")
                        .agg(F.collect_set("pos").alias("__drop")))

    results = {"doc_id", "text", "n_lines", "n_dropped"}
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       *[F.col(f"`{c}`") for c in keep if c not in results], row.alias("__row"))
    # A merge join at any size: the texts then move in proportion to the input.
    joined = slim.join(drops.withColumnRenamed("row", "__row").hint("merge"), "__row", "left")
    parts = F.split("text", "\n")
    kept = F.array_join(F.filter(parts, lambda line, i: ~F.array_contains("__drop", i)), "\n")
    return joined.select(
        "doc_id", F.when(F.col("__drop").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).alias("n_lines"),
        F.when(F.col("__drop").isNull(), 0).otherwise(F.size("__drop")).alias("n_dropped"),
        *[F.col(f"`{c}`") for c in keep if c not in results])
