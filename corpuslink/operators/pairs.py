"""True, false and labelled record pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import serialize_record
from .mediation import VEHICLE_SCHEMA
from .sampling import sample_keys
from .scale import by_shuffle, dense_rank_index, materialize, shuffled_rank

A_ID, B_ID = "orig_cl_id", "orig_uc_id"


def ground_truth(a: DataFrame, b: DataFrame, key: str = "vin", a_id: str = A_ID,
                 b_id: str = B_ID) -> DataFrame:
    """Ids of records with the same key."""
    return a.select(a_id, key).join(by_shuffle(b.select(b_id, key)), key).select(a_id, b_id)


def negative_pairs(a: DataFrame, b: DataFrame, n: int, seed: int | str, key: str = "vin",
                   a_id: str = A_ID, b_id: str = B_ID, exclude_true: bool = True) -> DataFrame:
    """n distinct random pairs with different keys.

    Both sides get a seeded random rank. Pairs are placed in a row: left rank i meets
    right rank i + k, for k = 0 first, then k = 1 and so on; the first n pairs with
    different keys are kept. Only so many places are looked at as n needs, and more
    only where equal keys have used them up; no more than the wanted rounds and the
    largest number of right rows with one key can be needed.
    """
    na, nb = a.count(), b.count()
    if not na or not nb or n <= 0:
        return ground_truth(a, b, key, a_id, b_id).where(F.lit(False))
    most = b.groupBy(key).count().agg(F.max("count")).first()[0] if exclude_true else 0
    last = min(-(-n // na) + most, nb) * na
    left = materialize(shuffled_rank(a.select(a_id, F.col(key).alias("key_a")), [a_id], f"{seed}|left", "i"))
    right = materialize(shuffled_rank(b.select(b_id, F.col(key).alias("key_b")), [b_id], f"{seed}|right", "j"))
    places, place = min(2 * n + 64, last), F.col("k").cast("bigint") * na + F.col("i")
    while True:
        pairs = (left.where(F.col("i") < places)
                 .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit((places - 1) // na))))
                 .withColumn("place", place).where(F.col("place") < places)
                 .withColumn("j", (F.col("i") + F.col("k")) % nb).join(by_shuffle(right), "j"))
        pairs = materialize(pairs.where("key_a <> key_b") if exclude_true else pairs)
        if places == last or pairs.count() >= n:
            break
        places = min(4 * places, last)
    ranked = dense_rank_index(pairs, F.floor(F.col("place") / max(1, places // 4096)), [F.col("place")],
                              name="pair_rank")
    return ranked.where(F.col("pair_rank") < n).select(a_id, b_id)


def training_pairs(truth: DataFrame, a: DataFrame, b: DataFrame, n: int = 50,
                   seed: int | str = 42, key: str = "vin", a_id: str = A_ID, b_id: str = B_ID,
                   exclude_true: bool = True) -> DataFrame:
    """At most n true pairs (label 1) and as many false pairs (label 0)."""
    pos = sample_keys(truth.select(a_id, b_id), [a_id, b_id], n, seed)
    neg = negative_pairs(a, b, min(n, pos.count()), seed, key, a_id, b_id, exclude_true)
    return pos.withColumn("label", F.lit(1)).unionByName(neg.withColumn("label", F.lit(0)))


def materialize_pairs(pairs: DataFrame, a: DataFrame, b: DataFrame, columns: Sequence[str],
                      a_id: str = A_ID, b_id: str = B_ID) -> DataFrame:
    """Attributes of both records as a_* and b_*; unknown ids are dropped."""
    side = lambda df, p, i: df.select(i, *[F.col(c).alias(f"{p}_{c}") for c in columns])
    return pairs.join(side(a, "a", a_id), a_id).join(side(b, "b", b_id), b_id)


def pair_texts(pairs: DataFrame, a: DataFrame, b: DataFrame, schema: Sequence[str] = VEHICLE_SCHEMA,
               key: str = "vin", a_id: str = A_ID, b_id: str = B_ID) -> DataFrame:
    """Labelled id pairs as (left, right, label) text; tabs and line ends become blanks.

    Other columns of the pairs are kept. Each side's texts are exchanged once, so pairs
    of several parts are best given together.
    """
    columns = [c for c in schema if c != key]
    line = lambda c: F.regexp_replace(c, r"[\t\r\n]+", " ")
    text = lambda df, i, name: by_shuffle(df.select(i, line(serialize_record(columns)).alias(name)))
    return (pairs.join(text(a, a_id, "left"), a_id).join(text(b, b_id, "right"), b_id)
            .select("left", "right", F.col("label").cast("int").alias("label"),
                    *[c for c in pairs.columns if c not in (a_id, b_id, "label")]))


def labelled_ids(truth: DataFrame, a: DataFrame, b: DataFrame, seed: int | str = 42, key: str = "vin",
                 a_id: str = A_ID, b_id: str = B_ID) -> DataFrame:
    """All true pairs of known ids (label 1) and as many false ones (label 0)."""
    known = truth.select(a_id, b_id).join(by_shuffle(a.select(a_id)), a_id, "left_semi").join(
        by_shuffle(b.select(b_id)), b_id, "left_semi")
    neg = negative_pairs(a, b, known.count(), seed, key, a_id, b_id)
    return known.withColumn("label", F.lit(1)).unionByName(neg.withColumn("label", F.lit(0)))


def labelled_pairs(truth: DataFrame, a: DataFrame, b: DataFrame, seed: int | str = 42,
                   schema: Sequence[str] = VEHICLE_SCHEMA, key: str = "vin",
                   a_id: str = A_ID, b_id: str = B_ID, parts: Sequence[str] | None = None) -> DataFrame:
    """All true pairs and as many false ones, as labelled text.

    With `parts`, values of a column `split` of the true pairs, each part gets false
    pairs by a seed of its own, and the texts of all parts are joined at once.
    """
    if parts is None:
        both = labelled_ids(truth, a, b, seed, key, a_id, b_id)
    else:
        both = reduce(DataFrame.unionByName, [
            labelled_ids(truth.where(F.col("split") == p), a, b, f"{seed}|{p}", key, a_id, b_id)
            .withColumn("split", F.lit(p)) for p in parts])
    return pair_texts(both, a, b, schema, key, a_id, b_id)
