"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, cycle, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.batches import id_and_text, map_batches, row_groups, text_bytes
from corpuslink.operators.components import components
from corpuslink.operators.scale import literal_rows, materialize

BITS = 64


def shingle_hashes(text: bytes, width: int, seed: int = 42) -> list[int]:
    """XXH64 of every run of `width` words, joined by one space; A-Z are lower-cased."""
    words = text.lower().split()  # on bytes: just A-Z, just the six ASCII white spaces
    if not words:
        return []
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return [digest(joined, seed)]
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:])]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 3) -> DataFrame:
    """doc_id and the 64-bit SimHash (bigint, bits as they are) of every row's whole text.

    A bit is set if it is set in more than half of the hashes of all word shingles,
    repeats included. A text of fewer words than `width` is one shingle; null, empty
    and blank texts have fingerprint 0. Repeated rows and null ids are kept.
    """
    def make():
        def step(batch: pa.RecordBatch) -> dict:
            data, bounds = text_bytes(batch.column("text"))
            out = np.zeros(len(bounds) - 1, np.uint64)
            for first, last in row_groups(bounds, 1 << 19):
                hashes, sizes = [], []
                for row in range(first, last):
                    found = shingle_hashes(data[bounds[row]:bounds[row + 1]].tobytes(), width)
                    hashes += found
                    sizes.append(len(found))
                rows, sizes = np.flatnonzero(sizes), np.array(sizes)
                if not len(rows):
                    continue
                bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                     bitorder="little")
                starts = np.cumsum(sizes) - sizes
                ones = np.add.reduceat(bits, starts[rows], axis=0, dtype=np.int32)
                majority = 2 * ones > sizes[rows, None]
                out[first + rows] = np.packbits(majority, axis=1, bitorder="little").view("<u8")[:, 0]
            return {"doc_id": batch.column("doc_id"), "fingerprint": out.view(np.int64)}

        return step

    kind = dict(docs.dtypes)[id_col]
    return map_batches(id_and_text(docs, id_col, text_col), make, f"doc_id {kind}, fingerprint bigint")


def covering_masks(radius: int, inside: int = (1 << BITS) - 1) -> list[int]:
    """Masks of bits of `inside`, of which at least one avoids any `radius` given bits.

    Bit i stands for a vector m(i) of radius + 1 binary digits, dealt in turn. Each
    non-zero vector v gives a mask of the bits whose m(i) is not orthogonal to v
    (mod 2). Up to `radius` bits span less than the whole space, so some v is
    orthogonal to all of them, and its mask holds none of them.
    """
    vectors = [v for v in product((0, 1), repeat=radius + 1) if any(v)]
    dealt = list(zip((i for i in range(BITS) if inside >> i & 1), cycle(vectors)))
    return [sum(1 << i for i, m in dealt if sum(x * y for x, y in zip(m, v)) % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def linked_in_buckets(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) from the first of each group of a bucket to its other members.

    `buckets` has one column, near: the different fingerprints of a small bucket. A
    group is what distances of `radius` bits or fewer connect inside the bucket.
    """
    def make():
        def step(batch: pa.RecordBatch) -> dict | None:
            lists = batch.column("near")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.array([len(x) for x in lists], np.int64)
            starts = np.cumsum(sizes) - sizes
            a, b = [], []
            for at, n in zip(starts.tolist(), sizes.tolist()):
                near = np.sort(values[at:at + n])
                bits = np.bitwise_count(near.view(np.uint64)[:, None] ^ near.view(np.uint64)[None, :])
                close = bits <= radius
                root = np.arange(n)
                while True:  # the smallest place that is reached in one more step
                    least = np.where(close, root[None, :], n).min(axis=1)
                    if np.array_equal(least, root):
                        break
                    root = least
                member = np.flatnonzero(root != np.arange(n))
                a.append(near[root[member]])
                b.append(near[member])
            return {"a": np.concatenate(a), "b": np.concatenate(b)} if a else None

        return step

    return map_batches(buckets, make, "a bigint, b bigint")


def near_pairs(prints: DataFrame, radius: int = 2, most: int = 64) -> DataFrame:
    """Links (a, b) between the different fingerprints of a frame (column fingerprint).

    The links connect just what all pairs within `radius` bits would connect. Any such
    pair has equal bits under one covering mask, so both stand in one bucket of that
    mask, and their distance is tested there. A bucket of more than `most` fingerprints is
    dealt again, by covering masks of the bits that its mask leaves out: again some mask
    avoids all bits in which a pair differs. Each time about half of the open bits become
    fixed, so that buckets end with few open bits and at most 2 to their number of fingerprints
    (with radius 2: 64, then 27, 12 and 6 open bits). No bucket lists its pairs; a
    group of it gives a link from its first member to each other one.
    """
    spark, full = prints.sparkSession, (1 << BITS) - 1
    reached, bits = covering_masks(radius), BITS  # the masks in use, and the most bits that one left open
    first = F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)])
    entries = prints.select("fingerprint", F.explode(first).alias("mask"))
    links, last = [], False
    while not last:
        entries = entries.withColumn("masked", F.col("fingerprint").bitwiseAND(F.col("mask")))
        # Written first: small enough it is broadcast, else a full bucket can be split over tasks.
        shared = materialize(entries.groupBy("mask", "masked").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        held = materialize(entries.join(shared, ["mask", "masked"]))
        # Buckets with so few open bits hold no more than `most`; masks of few bits may not shrink further.
        before, bits = bits, max(BITS - m.bit_count() for m in reached)
        last = 1 << bits <= most or bits == before
        small = held if last else held.where(F.col("n") <= most)
        near = small.groupBy("mask", "masked").agg(F.collect_list("fingerprint").alias("near"))
        links.append(linked_in_buckets(near.select("near"), radius))
        if not last:
            large = held.where(F.col("n") > most)
            last = large.isEmpty()
            children = [(_signed(m), _signed(m | c)) for m in reached for c in covering_masks(radius, full & ~m)]
            reached = sorted({c & full for _, c in children})
            table = F.broadcast(literal_rows(spark, children, "mask bigint, child bigint"))  # 49 or 343 rows
            entries = large.join(table, "mask").select("fingerprint", F.col("child").alias("mask")).distinct()
    return reduce(DataFrame.union, links).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 3, radius: int = 2) -> DataFrame:
    """Fingerprint and component of every row: doc_id, fingerprint (bigint), component_id.

    Texts whose fingerprints differ in `radius` bits or fewer are linked; the
    component is named by the smallest doc_id that links reach (null only where all
    ids are null). Equal fingerprints are one node with its smallest id, so copies
    are never paired. Rows without words share fingerprint 0 and are linked like any
    other. An empty table gives an empty table.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, width))
    nodes = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    label = components(near_pairs(nodes, radius)).withColumnRenamed("node", "fingerprint")
    joined = materialize(nodes.join(label, "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")))
    smallest = materialize(joined.groupBy("component").agg(F.min("first_id").alias("component_id")))
    named = materialize(joined.join(smallest, "component").select("fingerprint", "component_id"))
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
