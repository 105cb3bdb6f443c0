import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from corpuslink.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int, digest string, n int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(level, at):
    """Root over a level, and the siblings on the way up from place `at` as (side, digest)."""
    path = []
    while len(level) > 1:
        run = level[at // 2 * 2:at // 2 * 2 + 2]
        path.append((2, None) if len(run) < 2 else (at % 2, run[1 - at % 2]))
        level, at = [h(*level[k:k + 2]) for k in range(0, len(level), 2)], at // 2
    return level[0], path


def fold(x, path):
    for side, other in path:
        x = h(x) if side == 2 else h(x, other) if side == 0 else h(other, x)
    return x


def brute(rows):
    trees = {}
    for i, text, lang, source, n in rows:
        trees.setdefault("" if lang is None else "=" + lang, []).append((i is not None, i or 0, leaf(i, source, lang, n, text), (i, source, lang, n, text)))
    names = sorted(trees, key=str.encode)
    for leaves in trees.values():
        leaves.sort(key=lambda x: x[:3])
    subroots = [climb([x[2] for x in trees[name]], 0)[0] for name in names]
    out = []
    for place, name in enumerate(names):
        for at, (_, _, own, (i, source, lang, n, text)) in enumerate(trees[name]):
            subroot, low = climb([x[2] for x in trees[name]], at)
            root, high = climb(subroots, place)
            path = low + high
            tampered = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
            folded = fold(leaf(i, source, lang, n + 1, text) if tampered else own, path)
            out.append((i, own, subroot, root, h(*[d for side, d in path if side < 2]), folded, folded == root))
    return sorted(out, key=repr)


def check(spark, rows, folder):
    spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    got = queries.dataset_manifest(spark, str(folder)).collect()
    assert all(r.reached for r in got)
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == brute(rows)


def test_proofs_agree_with_brute_force(spark, tmp_path):
    langs = ["en"] * 50 + ["é"] * 33 + [None] * 32 + ["de"] * 3 + ["a"] + ["=", ""]
    rows = [(7 * k - 90, None if k % 11 == 0 else f"text é {k}", lang, None if k % 5 == 0 else "s", None if k % 4 == 0 else k)
            for k, lang in enumerate(langs)]
    rows += [rows[3], rows[3], (rows[4][0], "other text", "en", "s", 1), (None, None, None, None, None), (None, "x", "en", "s", 9), (10 ** 15, "", "en", "", 0)]
    assert any(zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None for r in rows)
    check(spark, rows, tmp_path)


@pytest.mark.parametrize("n", [1, 2, 33])
def test_small_trees(spark, tmp_path, n):
    check(spark, [(k, "t", "en", "s", k) for k in range(n)], tmp_path)


def test_more_records_than_are_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_RECORDS", 1)
    check(spark, [(k, f"t{k}", "en" if k % 3 else "fr", "s", k) for k in range(1100)], tmp_path)


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.dataset_manifest(spark, str(tmp_path)).count() == 0


def test_heights(spark):
    counts = [1, 2, 3, 4, 5, 32, 33, 2 ** 40, 2 ** 40 + 1]
    df = spark.createDataFrame([(c,) for c in counts], "n long").select(merkle.height(F.col("n")).alias("h"))
    assert [r.h for r in df.collect()] == [0, 1, 2, 2, 3, 5, 6, 40, 41]


def test_the_store_is_addressed_by_content(spark):
    rows = spark.createDataFrame([(k, b"same") for k in range(64)], "k long, digest binary")
    bands, _, _, _ = merkle.manifest(rows, F.lit("t"), "k")
    assert [b.count() for b in bands] == [1, 1]  # two equal records of 32 leaves, one above
