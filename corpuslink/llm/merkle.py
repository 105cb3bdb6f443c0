"""A Merkle manifest of a dataset as a content-addressed graph, and proofs by descent from its root.

A node is the SHA-256 of the digests of its two children (one where a level has an odd
number of nodes). The store has one record for each node at every fifth level: under
its digest, all nodes of the five levels below it. Whoever knows the root alone can
find any leaf by its rank: five binary digits of the rank lead from a record to the next.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.operators.scale import materialize, ordered_ids

#: Levels of the tree between the digest of a record and its lowest children.
DIGIT = 5
#: Records (of 2 KB at most) up to which a band is broadcast.
BROADCAST_RECORDS = 4_096
TOP = "*"


def digest(*parts: Column) -> Column:
    """SHA-256, as binary, of digests written as lower-case hex one after the other."""
    return F.unhex(F.sha2(F.concat(*[F.lower(F.hex(p)) for p in parts]), 256))


def field(value: Column) -> Column:
    """A value as its count of UTF-8 bytes, a colon and itself; null as a hyphen."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256, as binary, of the fields of a row."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def height(count: Column) -> Column:
    """Levels above the leaves of a tree of so many: the least h with 2 ** h >= count. Exact, without logarithms."""
    return F.length(F.bin(count - 1)).cast("int") - F.when(count <= 1, 1).otherwise(0)


def _up(nodes: Column) -> Column:
    """The level above a list of nodes."""
    def parent(k: Column) -> Column:
        left, right = F.get(nodes, 2 * k), F.get(nodes, 2 * k + 1)
        return F.when(right.isNull(), digest(left)).otherwise(digest(left, right))

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), parent)


def _records(nodes: DataFrame) -> DataFrame:
    """Records over `nodes` (tree, at, digest, levels left to the top) of one band.

    Not more than 2 ** DIGIT nodes come together for a record, however large a tree is.
    """
    grouped = nodes.groupBy("tree", "left", F.shiftright("at", DIGIT).alias("at")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda n: n["digest"]).alias("level0"))
    for k in range(1, DIGIT + 1):
        below = f"level{k - 1}"
        grouped = grouped.withColumn(f"level{k}", F.when(F.col("left") >= k, _up(F.col(below))).otherwise(F.col(below)))
    levels = F.array(*[f"level{k}" for k in range(DIGIT)])
    return grouped.select("tree", "at", F.get(f"level{DIGIT}", F.lit(0)).alias("digest"),
                          F.least("left", F.lit(DIGIT)).alias("n_levels"), "left",
                          F.slice(levels, 1, F.least("left", F.lit(DIGIT))).alias("children"))


def build(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Store and roots of the trees over `leaves` (tree, rank, digest, n: leaves of its tree).

    Returns the store in bands from the leaves up, each with `digest`, `n_levels` and
    `children` (the levels below the digest, lowest first), and the roots (tree, digest).
    Equal digests have one record: the store is addressed by content. A tree of one leaf
    has that leaf as its root and no record. A band has a record for 32 of the band below.
    """
    nodes = leaves.select("tree", F.col("rank").alias("at"), "digest", height(F.col("n")).alias("left"))
    done, bands = [nodes.where("left = 0").select("tree", "digest")], []
    nodes = nodes.where("left > 0")
    while nodes.limit(1).count():
        records = materialize(_records(nodes))
        bands.append(records.select("digest", "n_levels", "children").dropDuplicates(["digest", "n_levels"]))
        above = records.select("tree", "at", "digest", (F.col("left") - F.col("n_levels")).alias("left"))
        done.append(above.where("left = 0").select("tree", "digest"))
        nodes = above.where("left > 0")
    return bands, materialize(reduce(DataFrame.union, done))


def descend(requests: DataFrame, bands: list[DataFrame], digest_col: str = "digest") -> DataFrame:
    """Leads every request from its root to its leaf; adds the siblings met to its `path`.

    A request has `digest` (a root to begin with), `left` (levels down to its leaf),
    `rank` (of the leaf) and `path`, from the root down: for each level a struct of
    `side` (0: the sibling is on the right, 1: on the left, 2: there is none) and the
    sibling's digest. In a round the next digits of the rank choose among the
    children of the request's digest; the children not chosen give the siblings. The
    few records of the upper bands are broadcast; below, requests meet their record by
    its digest, which no more than a small part of them share. Requests of lower trees
    wait unshuffled.
    """
    for band, store in reversed(list(enumerate(bands))):
        floor = band * DIGIT
        active, waits = requests.where(F.col("left") > floor), requests.where(F.col("left") <= floor)
        records = store.select(F.col("digest").alias("__digest"), "n_levels", "children")
        if records.limit(BROADCAST_RECORDS + 1).count() <= BROADCAST_RECORDS:
            records = F.broadcast(records)
        here = (F.col(digest_col) == F.col("__digest")) & (F.col("left") - floor == F.col("n_levels"))

        def step(k: Column) -> Column:  # k levels above the lowest children of the record
            level = F.get("children", k)
            at = F.call_function("shiftright", F.col("digits"), k)
            other = F.get(level, at.bitwiseXOR(F.lit(1)))
            return F.struct(F.when(other.isNull(), 2).otherwise(at.bitwiseAND(F.lit(1))).alias("side"), other.alias("digest"))

        low = F.call_function("shiftleft", F.lit(1), F.col("n_levels"))
        joined = active.join(records, here).withColumn("digits", F.pmod(F.shiftright("rank", floor), low).cast("int"))
        segment = F.transform(F.sequence(F.col("n_levels") - 1, F.lit(0)), step)
        chosen = F.get(F.get("children", F.lit(0)), F.col("digits"))
        moved = {digest_col: chosen, "left": F.lit(floor), "path": F.concat("path", segment)}
        moved_on = joined.select(*[moved.get(c, F.col(c)).alias(c) for c in requests.columns])
        requests = moved_on.union(waits)
    return requests


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up (lowest first) lead to."""
    def up(below: Column, step: Column) -> Column:
        other = F.lower(F.hex(step["digest"]))
        return F.sha2(F.when(step["side"] == 0, F.concat(below, other)).when(step["side"] == 1, F.concat(other, below))
                      .otherwise(below), 256)

    return F.aggregate(path, F.lower(F.hex(leaf)), up)


def manifest(rows: DataFrame, tree: Column, order: str) -> tuple[list[DataFrame], list[DataFrame], DataFrame, DataFrame]:
    """Trees over `rows` (column `digest` and others), one for each value of `tree`, under one root.

    Leaves of a tree stand by `order`, null first, and by digest where that ties (equal
    leaves are interchangeable); trees stand by their name, null first. Returns the
    store of the trees, the store of the tree over their roots, the root (one row, none
    for no rows), and the rows with tree, rank, n, top_rank, top_n and subroot. `tree`
    is a column of strings.
    """
    # Null is a tree of its own, before all others: names get a leading sign, null is empty.
    named = rows.withColumn("tree", F.coalesce(F.concat(F.lit("="), tree), F.lit("")))
    ranked = ordered_ids(named, [order, "digest"], "rank", ["tree"], "n")
    ranked = materialize(ranked)
    bands, roots = build(ranked.select("tree", "rank", "digest", "n"))
    placed = roots.withColumn("all", F.lit(TOP)).withColumnRenamed("digest", "subroot")
    placed = materialize(ordered_ids(placed, ["tree"], "top_rank", ["all"], "top_n"))
    top_bands, root = build(placed.select(F.col("all").alias("tree"), F.col("top_rank").alias("rank"),
                                          F.col("subroot").alias("digest"), F.col("top_n").alias("n")))
    joined = ranked.join(placed.select("tree", "subroot", "top_rank", "top_n"), "tree")
    return bands, top_bands, root.select("digest"), joined


def prove(found: tuple[list[DataFrame], list[DataFrame], DataFrame, DataFrame]) -> DataFrame:
    """Adds to every row of a manifest its proof, got by descent: `root` and `path`, lowest sibling first.

    The request knows the root and the ranks of its tree and of its leaf only; that the
    descent ends at the row's own digest is returned as `reached`.
    """
    bands, top_bands, root, rows = found
    known = root.first()  # one digest
    top = F.lit(bytes(known["digest"]) if known else None).cast("binary")
    nothing = F.array().cast("array<struct<side:int,digest:binary>>")
    requests = rows.withColumns({"root": top, "at": top, "left": height(F.col("top_n")), "path": nothing,
                                  "leaf_rank": F.col("rank"), "rank": F.col("top_rank")})
    requests = descend(requests, top_bands, "at")
    requests = requests.withColumns({"left": height(F.col("n")), "rank": F.col("leaf_rank")})
    ends = descend(requests, bands, "at")
    return ends.withColumns({"reached": F.col("at") == F.col("digest"), "path": F.reverse("path")}).drop("at", "left", "leaf_rank")
