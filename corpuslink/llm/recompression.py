"""Repeated passages by recompression: runs and pairs of tokens get names, round by round."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.batches import id_and_text, map_batches, row_groups, text_bytes
from corpuslink.operators.scale import materialize

U = np.uint64
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_RNG = np.random.default_rng(20240607)
BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
PLACE = _RNG.integers(1, 1 << 63, 4096, dtype=np.uint64) * U(2) + U(1)
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_names(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names (64-bit hashes) of the words of rows, and where the words of each row begin.

    `bounds` are the n + 1 offsets of the rows in the bytes; words are parted by ASCII
    white space and by the ends of rows.
    """
    inside = ~SPACE[data]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    size = end - start
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, size)
    value = BYTE[data[at]] * PLACE[place & 4095] * (U(2) * (place >> 12).astype(U) + U(1))
    sums = np.add.reduceat(value, np.cumsum(size) - size) if len(size) else value
    return mixed(sums + size.astype(U)), np.searchsorted(start, bounds)


class Spans:
    """Names of spans of consecutive words, the same wherever the words are the same."""

    def __init__(self, names: np.ndarray):
        n = len(names) + 1
        power = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, STEP, U)]))
        self._back = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, BACK, U)]))
        self._sum = np.concatenate([[U(0)], np.cumsum(names * power[:-1])])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sum[end] - self._sum[start]) * self._back[start] + (end - start).astype(U))


def symbols(names: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, ...]:
    """First and end word of the context that each symbol depends on, after some rounds.

    `first` holds the first word of every row, and the count of words. In a round every
    symbol is left or right by a bit of its name. Neighbours join if they are equal, or
    if the first is left and the second right; so a block is a run, or a run of left
    symbols and one of right symbols, and its name tells which and how many. Whether
    neighbours join depends on them alone. A block depends on its symbols and on one
    neighbour at either side, or on the end of the row: wherever the words of its
    context occur inside a row, the same symbol arises there. A context that meets the
    end of a row reaches one word beyond it.
    """
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    name, begin, end = names, np.arange(len(names)), np.arange(1, len(names) + 1)
    for r in range(rounds):
        left = mixed(name + U(r + 1)) >> U(63) == 0
        joined = (row[1:] == row[:-1]) & ((name[1:] == name[:-1]) | (left[:-1] & ~left[1:]))
        starts = np.flatnonzero(np.concatenate([[True], ~joined]))
        stops = np.concatenate([starts[1:], [len(name)]])
        size = stops - starts
        leading = np.add.reduceat(name == np.repeat(name[starts], size), starts, dtype=np.int64)
        block = mixed(name[starts] * U(STEP) + mixed(name[stops - 1]) + U(3) * leading.astype(U)
                      + mixed(size.astype(U)))
        rows = row[starts]
        before, after = np.maximum(starts - 1, 0), np.minimum(stops, len(name) - 1)
        begin = np.where((starts > 0) & (row[before] == rows), begin[before], first[rows] - 1)
        end = np.where((stops < len(name)) & (row[after] == rows), end[after], first[rows + 1] + 1)
        name, row = np.where(size > 1, block, name[starts]), rows
    return begin, end


def segments(names: np.ndarray, first: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that one symbol stands for: (key, content, first window, windows).

    Of the symbols whose context lies in a window, the one with the smallest name of its
    context stands for it: equal windows have equal symbols, hence equal keys, wherever
    they are. A window without one (in long runs, or among very long symbols) is its own
    key. The content names all words of the run's windows and the place of the key there.
    """
    n = len(names)
    span = Spans(names)
    starts = [np.arange(a, b - window + 1) for a, b in zip(first[:-1], first[1:]) if b - a >= window]
    if not starts:
        empty = np.zeros(0, np.int64)
        return empty.astype(U), empty.astype(U), empty, empty
    at = np.concatenate(starts)
    begin, end = symbols(names, first, rounds)
    sound = (end - begin <= window) & (begin >= 0) & (end <= n)
    begin, end = begin[sound], end[sound]
    keys = span(begin, end)
    low, high = np.searchsorted(begin, at), np.searchsorted(end, at + window, "right")
    rank = np.empty(len(keys), np.int64)
    order = np.argsort(keys, kind="stable")
    rank[order] = np.arange(len(keys))
    level = np.zeros(len(at), np.int64)
    some = high > low
    level[some] = np.log2(high[some] - low[some]).astype(np.int64)
    least = np.full(len(at), -1)
    table, depth = rank, 0
    while some.any():
        here = some & (level == depth)
        least[here] = np.minimum(table[low[here]], table[high[here] - (1 << depth)])
        depth += 1
        if depth > level.max():
            break
        half = 1 << (depth - 1)
        table = np.minimum(table[:-half], table[half:]) if len(table) > half else table
    chosen = order[least] if len(order) else least
    alone = mixed(span(at, at + window) ^ U(1))
    key = np.where(some, keys[chosen], alone) if len(order) else alone
    place = np.where(some, begin[chosen], -1) if len(order) else least
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1]) | (place[1:] != place[:-1])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(at)))
    start = at[heads]
    offset = np.where(place[heads] >= 0, place[heads] - start, -1)
    content = mixed(span(start, start + count - 1 + window) ^ mixed(offset.astype(U)))
    return key[heads], content, start, count


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _keyed(docs: DataFrame, window: int, rounds: int, kind: str) -> DataFrame:
    """Segments of every row: doc_id, key, content, start (word of the row) and windows."""
    def make():
        def step(batch: pa.RecordBatch) -> dict | None:
            data, bounds = text_bytes(batch.column("text"))
            out = []
            for a, b in row_groups(bounds, 1 << 20):
                names, first = word_names(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                key, content, start, count = segments(names, first, window, rounds)
                row = np.searchsorted(first, start, "right") - 1
                out.append((a + row, _signed(key), _signed(content), start - first[row], count))
            rows, key, content, start, count = (np.concatenate(x) for x in zip(*out))
            taken = {n: batch.column(n).take(pa.array(rows)) for n in ("doc_id", "row")}
            return taken | {"key": key, "content": content, "start": start, "windows": count}

        return step

    return map_batches(docs, make, f"doc_id {kind}, row bigint, key bigint, content bigint, start bigint, windows bigint")


def _windows(docs: DataFrame, window: int, kind: str) -> DataFrame:
    """Names of single windows of the segments listed with each text; equal ones of a segment once."""
    def make():
        def step(batch: pa.RecordBatch) -> dict | None:
            data, bounds = text_bytes(batch.column("text"))
            parts = []
            for row, listed in enumerate(batch.column("listed").to_pylist()):
                names, _ = word_names(data[bounds[row]:bounds[row + 1]], np.array([0, bounds[row + 1] - bounds[row]]))
                span = Spans(names)
                for x in listed:
                    at = np.arange(x["start"], x["start"] + x["windows"])
                    parts.append((row, x["key"], x["content"], at - x["start"], _signed(span(at, at + window))))
            sizes = [len(p[3]) for p in parts]
            rows, key, content = (np.repeat(np.array([p[k] for p in parts], np.int64), sizes) for k in range(3))
            taken = {n: batch.column(n).take(pa.array(rows)) for n in ("doc_id", "row")}
            return taken | {"key": key, "content": content, "at": np.concatenate([p[3] for p in parts]),
                            "name": np.concatenate([p[4] for p in parts])}

        return step

    return map_batches(docs, make, f"doc_id {kind}, row bigint, key bigint, content bigint, at bigint, name bigint")


def _stripped(docs: DataFrame, window: int, kind: str) -> DataFrame:
    """Texts without the words of the windows that start in the given runs of words."""
    def make():
        def step(batch: pa.RecordBatch) -> dict:
            kept, total, removed = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
                words = (text.as_py() or "").encode().split()
                total.append(len(words))
                if runs:
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, [r["start"] for r in runs], 1)
                    np.add.at(step, [r["start"] + r["windows"] - 1 + window for r in runs], -1)
                    keep = np.cumsum(step[:-1]) == 0
                    words = [w for w, k in zip(words, keep) if k]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            return {"doc_id": batch.column("doc_id"), "n_words": total, "n_removed": removed, "text": kept}

        return step

    return map_batches(docs, make, f"doc_id {kind}, n_words bigint, n_removed bigint, text string")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int = 50, rounds: int = 4) -> DataFrame:
    """Remove every word of a window that also starts in a document with a smaller id.

    A window is `window` consecutive words (runs of characters other than ASCII white
    space) of one row. Rounds of recompression give each window a key, the same
    wherever it occurs (`segments`). Keys that occur in one document only are dropped.
    For the rest, runs of windows with the same whole content are settled at once; only
    where a key comes with several contents, at the edges of repeats, are single
    windows compared, for one document of each content.

    Returns doc_id, n_words, n_removed and text (kept words, joined by a space), one row
    per input row. Null texts have no words. Rows with null ids lose nothing and take
    nothing from others; rows with one id are one document, which takes nothing from
    itself. Names are 64-bit hashes of words, the same in all tasks.
    """
    kind = dict(docs.dtypes)[id_col]
    source = id_and_text(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))
    found = materialize(_keyed(source.where("doc_id is not null and text is not null"), window, rounds, kind))
    spread = materialize(found.groupBy("key").agg(F.min("doc_id").alias("key_doc"), F.max("doc_id").alias("most"))
                         .where("key_doc < most").drop("most"))
    shared = materialize(found.join(spread, "key"))
    contents = materialize(shared.groupBy("key", "content").agg(
        F.min("doc_id").alias("content_doc"), F.min("key_doc").alias("key_doc"),
        F.min(F.struct("doc_id", "row", "start", "windows")).alias("one")))
    settled = shared.join(contents.select("key", "content", "content_doc"), ["key", "content"]).where(
        "content_doc < doc_id").select("row", "start", "windows")

    edges = contents.where("content_doc > key_doc").select("key").distinct()
    listed = contents.join(edges, "key", "left_semi").select("one.*", "key", "content").groupBy("row").agg(
        F.collect_list(F.struct("key", "content", "start", "windows")).alias("listed"))
    single = materialize(_windows(source.join(listed, "row"), window, kind))
    earliest = materialize(single.groupBy("name").agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("most"))
                           .where("earliest < most").drop("most"))
    # Every row of the listed document: rows of one id can hold the same content in different texts.
    again = single.join(earliest, "name").where("earliest < doc_id").select("doc_id", "key", "content", "at")
    lone = shared.select("doc_id", "row", "key", "content", "start").join(again, ["doc_id", "key", "content"]).select(
        "row", (F.col("start") + F.col("at")).alias("start"), F.lit(1).cast("bigint").alias("windows"))
    runs = settled.union(lone).groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    return _stripped(source.join(runs, "row", "left"), window, kind)
