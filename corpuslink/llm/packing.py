"""Packing of token sequences by best fit over a histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.llm.batches import id_and_text, map_batches
from corpuslink.llm.wordpieces import WordPieces, Store, packed, portions
from corpuslink.operators.scale import materialize


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 size: int = 4096, separator: int = 1) -> DataFrame:
    """Token ids of every whole text, then `separator`, cut into pieces of at most `size`.

    `tokenizer` is the path, on every executor, of a byte-level BPE file that
    lower-cases and drops white space. Returns doc_id, piece (from 0), start (ids of
    the document before it), length and ids (unsigned 32-bit, little-endian). Null
    and empty texts are one piece that holds the separator alone; repeated rows each
    have their own pieces.
    """
    def make():
        pieces = WordPieces(tokenizer, lower=True)
        words = Store(pieces.ids)
        end = packed([separator])

        def step(batch: pa.RecordBatch) -> dict:
            out = defaultdict(list)
            rows = []
            for row, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # no white space to the library
                    ids = packed(pieces.whole(text)) + end
                else:
                    ids = b"".join([pieces.plain_ids(part) if pieces.plain(part) else
                                    b"".join(map(words.__getitem__, part.split()))
                                    for part in portions(text)]) + end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    rows.append(row)
                    out["piece"].append(k)
                    out["start"].append(at // 4)
                    out["ids"].append(ids[at:at + 4 * size])
                    out["length"].append(len(out["ids"][-1]) // 4)
            return {"doc_id": batch.column("doc_id").take(pa.array(rows)), **out}

        return step

    kind = dict(docs.dtypes)[id_col]
    return map_batches(id_and_text(docs, id_col, text_col), make,
                       f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def plan_bins(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit-decreasing over counts: groups of equal bins as (bins, [(length, per bin)]).

    Longest first; each goes where the least room is left that still holds it. Equal
    bins are one group, so the work depends on the number of different lengths, at
    most `size`, and not on the number of documents.
    """
    room: dict[int, list[tuple[int, list]]] = defaultdict(list)  # room left -> groups
    open_rooms: list[int] = []
    done = []

    def put(left: int, bins: int, items: list) -> None:
        if left == 0:
            done.append((bins, items))
            return
        if not room[left]:
            insort(open_rooms, left)
        room[left].append((bins, items))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            k = bisect_left(open_rooms, length)
            if k == len(open_rooms):
                left, bins, items = size, n, []  # new bins, as many as may be needed
            else:
                left = open_rooms[k]
                bins, items = room[left].pop()
                if not room[left]:
                    open_rooms.pop(k)
            per = left // length
            full = min(bins, n // per)
            if full:
                put(left - per * length, full, [*items, (length, per)])
                n -= full * per
            rest = bins - full
            if n and rest:  # fewer than one bin's worth is left: it shares one bin
                last = min(n, per)
                put(left - last * length, 1, [*items, (length, last)])
                n -= last
                rest -= 1
            if rest and items:
                put(left, rest, items)
    return done + [g for left in open_rooms for g in room[left]]


class Slots:
    """Where the piece of some rank among the pieces of its length goes; searched by arrays."""

    RANKS = 1 << 48

    def __init__(self, groups: list[tuple[int, list[tuple[int, int]]]]):
        rows, used, first = [], defaultdict(int), 0
        for bins, items in groups:
            offset = 0
            for length, per in items:
                rows.append((length, used[length], per, first, offset))
                used[length] += bins * per
                offset += length * per
            first += bins
        table = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        self._length, self._rank, self._per, self._first, self._offset = table
        self._key = self._length * self.RANKS + self._rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self._key, length * self.RANKS + rank, "right") - 1
        inside = rank - self._rank[at]
        return (self._first[at] + inside // self._per[at],
                self._offset[at] + inside % self._per[at] * length)


def _numbered(pieces: DataFrame) -> DataFrame:
    """Add the partition of each row and its rank there among rows of its length.

    The result is written out, so that both stay as they are when it is read again.
    """
    names = pieces.columns

    def make():
        seen: dict[int, int] = defaultdict(int)
        part = TaskContext.get().partitionId()

        def step(batch: pa.RecordBatch) -> dict:
            ranks = []
            for length in batch.column("length").to_pylist():
                ranks.append(seen[length])
                seen[length] += 1
            return {n: batch.column(n) for n in names} | {
                "__part": [part] * len(ranks), "__rank": ranks}

        return step

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return materialize(map_batches(pieces, make, f"{fields}, __part int, __rank bigint"))


def pack(pieces: DataFrame, size: int = 4096) -> DataFrame:
    """Give every piece a sequence of at most `size` tokens and an offset there.

    `pieces` holds a column length (1 to `size`); other columns are kept. Only the
    counts of the lengths, at most `size` numbers, reach the driver. They are packed
    by best fit, longest first, and a piece takes the slot of its rank among the
    pieces of its length: partitions number their own pieces, and the counts of
    earlier partitions are added. Adds sequence_id and offset; the pieces of a
    sequence leave no gap. Which of the pieces of a length takes which slot is of no
    meaning. An empty table gives an empty table.
    """
    rows = _numbered(pieces)
    here = rows.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    counts = {r["length"]: r["n"] for r in here.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    if any(not 0 < n <= size for n in counts):
        raise ValueError(f"lengths must be 1 to {size}")
    slots = Slots(plan_bins(counts, size))
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = here.select("length", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    ranked = rows.join(before, ["length", "__part"]).withColumn(
        "__rank", F.col("__rank") + F.col("__before")).drop("__part", "__before")
    names = [c for c in ranked.columns if c != "__rank"]

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "__rank"))
            sequence, offset = slots.place(length, rank)
            return {n: batch.column(n) for n in names} | {"sequence_id": sequence, "offset": offset}

        return step

    fields = ", ".join(f"`{c}` {t}" for c, t in ranked.dtypes if c != "__rank")
    return map_batches(ranked, make, f"{fields}, sequence_id bigint, offset bigint")
