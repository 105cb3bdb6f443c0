"""End-to-end record linkage: build the sources, export pairs, evaluate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import common_keys, dedup_first, distinct_keys, keep_common, keep_keys
from ..operators.learned import apply_linker, train_linker
from ..operators.matching import block_keys, neighbourhood_keys
from ..operators.mediation import (DEALER_MAPPING, LISTING_MAPPING, align_to_schema, drop_key,
                                   read_matching, source_column)
from ..operators.metrics import blocking_report, pair_metrics, profile_metrics
from ..operators.pairs import A_ID, B_ID, labelled_pairs, training_pairs
from ..operators.rules import ATTRIBUTES, rule_profiles
from ..operators.sampling import sample_keys, split_pairs
from ..operators.scale import materialize
from ..sources.pairs import write_pair_lines

POOL, TARGET = 15_000, 2_000


def build_sources(a: DataFrame, b: DataFrame, order: Sequence[str], pool: int | None = POOL,
                  target: int | None = TARGET, seed: int | str = 42,
                  a_mapping: Mapping[str, str] = LISTING_MAPPING,
                  b_mapping: Mapping[str, str] = DEALER_MAPPING) -> tuple[DataFrame, DataFrame]:
    """Two sources with one row per key, reduced to the keys they share.

    With pool and target None all shared keys are used; otherwise `pool` random
    keys are read and `target` of the surviving keys are kept.
    """
    ka, kb = source_column(a_mapping, "vin"), source_column(b_mapping, "vin")
    keys = common_keys(distinct_keys(a, ka), distinct_keys(b, kb))
    if pool is not None:
        keys = sample_keys(keys, ["key"], pool, f"{seed}|pool")
    a1 = dedup_first(read_matching(a, keys, a_mapping), [ka], order)
    b1 = dedup_first(read_matching(b, keys, b_mapping), [kb], order)
    if target is None:
        return keep_common(a1, ka, b1, kb)
    left = common_keys(a1.select(F.col(ka).alias("key")), b1.select(F.col(kb).alias("key")))
    final = sample_keys(left, ["key"], target, f"{seed}|target")
    return keep_keys(a1, ka, final), keep_keys(b1, kb, final)


def mediate(a: DataFrame, b: DataFrame, keep_a: Sequence[str] = (), keep_b: Sequence[str] = (),
            a_mapping: Mapping[str, str] = LISTING_MAPPING,
            b_mapping: Mapping[str, str] = DEALER_MAPPING) -> tuple[DataFrame, DataFrame]:
    """Both sources in the mediated schema."""
    return align_to_schema(a, a_mapping, keep=keep_a), align_to_schema(b, b_mapping, keep=keep_b)


def export_pairs(truth: DataFrame, a: DataFrame, b: DataFrame, seed: int | str = 42,
                 path: str | None = None) -> DataFrame:
    """Labelled text of the train, val and test split with a `split` column.

    With a path each split is also written as lines under its own folder.
    """
    names = ("train", "val", "test")
    split = materialize(split_pairs(truth, [A_ID, B_ID], seed))
    pairs = labelled_pairs(split, a, b, seed, parts=names)
    if path:
        pairs = materialize(pairs)
        for name in names:
            write_pair_lines(pairs.where(F.col("split") == name), f"{path}/{name}", seed)
    return pairs


def blockings(a: DataFrame, b: DataFrame, window: int = 1) -> dict[str, tuple[DataFrame, DataFrame]]:
    """The two blockings: B1 equal make, B2 neighbouring year."""
    return {"B1": block_keys(a, b, "make"), "B2": neighbourhood_keys(a, b, "year", window)}


def evaluate_rules(a: DataFrame, b: DataFrame, truth: DataFrame, window: int = 1) -> DataFrame:
    """Metrics of the rule linkage and the blocking report, one row per blocking."""
    a, b = drop_key(a), drop_key(b)
    rows = []
    for name, (xa, xb) in blockings(a, b, window).items():
        equal = "make" if name == "B1" else "year" if window == 1 else None
        matched = rule_profiles(xa, xb, equal=equal)
        metrics = profile_metrics(matched, truth, xa, xb, ATTRIBUTES, A_ID, B_ID)
        report = blocking_report(xa, xb, truth, A_ID, B_ID)
        tag = F.lit(name).alias("strategy")
        rows.append(metrics.select(tag, "*").join(
            report.select(tag, "candidates", "captured", "recall_ceiling"), "strategy"))
    return reduce(DataFrame.unionByName, rows)


def evaluate_learned(a: DataFrame, b: DataFrame, train: DataFrame, truth: DataFrame,
                     seed: int | str = 42, threshold: float = 0.5) -> DataFrame:
    """Metrics of the learned one-to-one linkage, one row per blocking."""
    labelled = training_pairs(train, a, b, 50, seed)
    model = train_linker(labelled, a, b)
    rows = []
    for name, (xa, xb) in blockings(drop_key(a), drop_key(b)).items():
        links = apply_linker(model, xa, xb, threshold)
        rows.append(pair_metrics(links, truth, A_ID, B_ID).select(F.lit(name).alias("strategy"), "*"))
    return reduce(DataFrame.unionByName, rows)
