"""Byte-level BPE with token offsets; pre-tokens come from scans of arrays, not from a regular expression.

Every code point has a class, and every class (with what follows it) is a function
from the state before a character to the state after it. Composing functions is
associative, so the states of all characters come from a scan over blocks, and
boundaries are read off states and classes.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, product

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.batches import map_batches, row_groups, text_bytes

#: Bytes of rows that are scanned together; a longer row is scanned alone, in stretches of so many characters.
GROUP, STRETCH = 1 << 19, 1 << 20
#: Bytes of slices and ids that a task keeps. Longer slices are merged one by one and not kept.
STORE_BYTES, SHORT_SLICE = 96 << 20, 48
#: Slices that are merged at the same time.
TOGETHER = 1 << 14
#: More than any rank.
NONE = 1 << 40
#: Characters of a block of the scan.
BLOCK = 128

# Classes of code points. END stands after each row.
OTHER, LETTER, NUMBER, BLANK, SPACE, END = range(6)
# Symbols of a scan: the classes, and an apostrophe before the one or two letters of a contraction.
SHORT, LONG = 6, 7
# States: an apostrophe can begin a contraction next (after letters, numbers, white space but
# blanks, and at a start), or it cannot; one or two letters of a contraction are still to come; one has just ended.
OPEN, SHUT, ONE, TWO, DONE = range(5)
STATES = 5


def _after(state: int, symbol: int) -> int:
    """The state after a character."""
    if state in (ONE, TWO) and symbol == LETTER:
        return ONE if state == TWO else DONE
    if symbol in (SHORT, LONG):  # behind a blank or within a run of others it is one of them
        return SHUT if state == SHUT else (ONE if symbol == SHORT else TWO)
    return SHUT if symbol in (OTHER, BLANK) else OPEN


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' functions: a table of them, their products, and each symbol's number."""
    functions = [tuple(_after(s, symbol) for s in range(STATES)) for symbol in range(8)]
    known: dict[tuple[int, ...], int] = {tuple(range(STATES)): 0}
    queue = [*known]
    for one in queue:
        for step in functions:
            both = tuple(step[s] for s in one)
            if both not in known:
                known[both] = len(known)
                queue.append(both)
    table = np.array(list(known), np.uint8)
    products = np.array([[known[tuple(b[s] for s in a)] for b in known] for a in known], np.uint8)
    return table, products, np.array([known[f] for f in functions], np.uint8)


FUNCTIONS, PRODUCTS, OF_SYMBOL = _monoid()


def _starts_token() -> np.ndarray:
    """For a state, the class before and a symbol: 1 if a token starts there, 2 if that hangs on what follows."""
    table = np.zeros((STATES, 6, 8), np.uint8)
    for state, before, symbol in product(range(STATES), range(6), range(8)):
        if state in (ONE, TWO):
            starts = 0
        elif symbol == END or before == END or state == DONE:
            starts = 1
        elif symbol in (BLANK, SPACE):  # the last of several white spaces before a word stands by itself
            starts = 2 if before in (BLANK, SPACE) else 1
        elif symbol in (SHORT, LONG):
            starts = state != SHUT
        else:
            starts = before not in (symbol, BLANK)
        table[state, before, symbol] = starts
    return table


STARTS = _starts_token()


@cache
def classes() -> np.ndarray:
    """The class of every code point, by the Unicode tables of the installed library.

    Python's own tables can be of another version of Unicode, so the library is asked
    once per process which characters are letters, numbers and white space.
    """
    table = np.zeros(0x110000, np.uint8)
    points = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4")
    every = points.tobytes().decode("utf-32-le")
    ranks = {bytes([b]): b for b in range(256)}
    for number, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(every)
        table[np.frombuffer(bytes(found).decode().encode("utf-32-le"), "<u4")] = number
    table[ord(" ")] = BLANK
    return table


def scan(functions: np.ndarray) -> np.ndarray:
    """The composition of each function with all before it, by blocks and then over the blocks' totals."""
    n = len(functions)
    if n <= 1:
        return functions
    size = min(BLOCK, max(2, n))
    blocks = np.zeros(-(-n // size) * size, np.uint8)  # 0 is the identity
    blocks[:n] = functions
    blocks = blocks.reshape(-1, size).T.copy()
    for k in range(1, size):
        blocks[k] = PRODUCTS[blocks[k - 1], blocks[k]]
    if blocks.shape[1] > 1:
        before = np.zeros(blocks.shape[1], np.uint8)
        before[1:] = scan(blocks[-1])[:-1]
        blocks = PRODUCTS[before[None, :], blocks]
    return blocks.T.reshape(-1)[:n]


def _symbols(points: np.ndarray, kinds: np.ndarray, n: int) -> np.ndarray:
    """Symbols of the first n characters; up to two more are looked at."""
    symbols = kinds[:n].copy()
    marks = np.flatnonzero(points[:n] == ord("'"))
    if len(marks):
        ahead = np.zeros(n + 2, points.dtype)
        ahead[:len(points)] = points
        first, second = ahead[marks + 1], ahead[marks + 2]
        symbols[marks[np.isin(first, [*map(ord, "stmd")])]] = SHORT
        for a, b in ("re", "ve", "ll"):
            symbols[marks[(first == ord(a)) & (second == ord(b))]] = LONG
    return symbols


def token_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each character; characters of class END end a row."""
    starts, state, n = np.zeros(len(points), bool), OPEN, len(points)
    for at in range(0, n, STRETCH):
        end = min(n, at + STRETCH)
        symbols = _symbols(points[at:end + 2], kinds[at:end + 2], end - at)
        after = FUNCTIONS[scan(OF_SYMBOL[symbols]), state]
        states, before, following = np.empty_like(after), np.full(end - at, END), np.full(end - at, END)
        states[0], states[1:] = state, after[:-1]
        before[at == 0:] = kinds[max(0, at - 1):end - 1]
        following[:min(n, end + 1) - at - 1] = kinds[at + 1:end + 1]
        found = STARTS[states, before, symbols]
        starts[at:end] = (found == 1) | ((found == 2) & (following < BLANK))
        state = after[-1]
    return starts


class Ranks:
    """The tokens of a rank file: ranks by bytes, bytes by rank, and which pairs of tokens make a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.flat, self.begins = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)])
        self.lengths, self.of_byte = np.diff(self.begins), np.array([self.ranks[bytes([b])] for b in range(256)])
        get = self.ranks.get
        pairs = sorted((left << 32 | right, rank) for token, rank in self.ranks.items() for at in range(1, len(token))
                       if (left := get(token[:at])) is not None and (right := get(token[at:])) is not None)
        self._keys, self._ranks = np.array([*pairs, (1 << 62, 0)], np.int64).T.copy()

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of the tokens that neighbours make, NONE where they make none."""
        keys = left << 32 | right
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._ranks[at], NONE)

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many slices, each merged by itself, all of one length at the same time.

        In a step each slice merges those neighbours that make the token of the lowest
        rank, the left-most of equals, until no neighbours make one. A slice that is a
        token is that token.
        """
        found: dict[bytes, bytes] = {}
        by_length = defaultdict(list)
        for piece in pieces:
            if (rank := self.ranks.get(piece)) is not None:
                found[piece] = rank.to_bytes(4, "little")
            elif len(piece) > SHORT_SLICE:
                found[piece] = np.array(_merged_long(piece, self.ranks), "<u4").tobytes()
            else:
                by_length[len(piece)].append(piece)
        parts = ((length, alike[at:at + TOGETHER]) for length, alike in by_length.items()
                 for at in range(0, len(alike), TOGETHER))
        for length, alike in parts:
            ids = self.of_byte[np.frombuffer(b"".join(alike), np.uint8).reshape(-1, length)]
            sizes = self._merge(ids)
            packed = ids.astype("<u4").tobytes()
            found.update((piece, packed[4 * length * k:4 * (length * k + n)])
                         for k, (piece, n) in enumerate(zip(alike, sizes.tolist())))
        return [found[piece] for piece in pieces]

    def _merge(self, ids: np.ndarray) -> np.ndarray:
        """Merges each row of `ids` in place and returns how many ids it then has."""
        sizes = np.full(len(ids), ids.shape[1])
        pairs = np.column_stack([self.of_pairs(ids[:, :-1], ids[:, 1:]), np.full(len(ids), NONE)])
        rows = np.arange(len(ids))
        while len(rows):
            low = pairs[rows].argmin(axis=1)
            rank = pairs[rows, low]
            rows, low, rank = rows[rank < NONE], low[rank < NONE], rank[rank < NONE]
            source = np.minimum(np.arange(ids.shape[1]) + (np.arange(ids.shape[1]) > low[:, None]), ids.shape[1] - 1)
            left, right = np.take_along_axis(ids[rows], source, 1), np.take_along_axis(pairs[rows], source, 1)
            each = np.arange(len(rows))
            left[each, low] = rank
            sizes[rows] -= 1
            last = low + 1 >= sizes[rows]  # no neighbour to the right
            after = left[each, np.minimum(low + 1, ids.shape[1] - 1)]
            right[each, low] = np.where(last, NONE, self.of_pairs(rank, after))
            inner = low > 0
            right[each[inner], low[inner] - 1] = self.of_pairs(left[each[inner], low[inner] - 1], rank[inner])
            right[each, sizes[rows] - 1] = NONE
            ids[rows], pairs[rows] = left, right
        return sizes


@cache
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for one slice: neighbours wait in a heap by rank and place, so that n bytes take n log n steps."""
    n = len(piece)
    ends, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    waiting = [(rank, at, at + 2) for at in range(n - 1) if (rank := ranks.get(piece[at:at + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, at, end = heapq.heappop(waiting)
        after = right[at]
        if after < 0 or after >= n or ends[after] != end:  # one of the two has been merged since
            continue
        ends[at], right[at], right[after] = end, right[after], -1
        if right[at] < n:
            left[right[at]] = at
            if (rank := ranks.get(piece[at:ends[right[at]]])) is not None:
                heapq.heappush(waiting, (rank, at, ends[right[at]]))
        if (before := left[at]) >= 0 and (rank := ranks.get(piece[before:end])) is not None:
            heapq.heappush(waiting, (rank, before, end))
    found, at = [], 0
    while at < n:
        found.append(ranks[piece[at:ends[at]]])
        at = right[at]
    return found


class Merges(dict):
    """Packed ids of slices that were merged before, up to a number of bytes."""

    def __init__(self, ranks: Ranks):
        self._ranks, self._bytes = ranks, 0

    def encode(self, rows: list[list[bytes]]) -> list[bytes]:
        """Packed ids of rows that are given as slices; slices not seen before are merged together."""
        if self._bytes > STORE_BYTES:
            self.clear()
            self._bytes = 0
        new = list(set(chain.from_iterable(rows)).difference(self))
        self.update(zip(new, self._ranks.merged(new)))
        packed = [b"".join(map(self.__getitem__, row)) for row in rows]
        for piece in new:
            if len(piece) > SHORT_SLICE:
                del self[piece]
            else:  # with what the objects and their place take
                self._bytes += 5 * len(piece) + 180
        return packed


def slices(data: np.ndarray, bounds: np.ndarray) -> Iterator[list[list[bytes]]]:
    """The pre-tokens of each row, as slices of its bytes, for groups of rows."""
    for first, last in row_groups(bounds, GROUP):
        part = data[bounds[first]:bounds[last]]
        inner = bounds[first:last + 1] - bounds[first]
        heads = np.flatnonzero((part & 0xC0) != 0x80)  # the first bytes of characters
        points = np.frombuffer(part.tobytes().decode().encode("utf-32-le"), "<u4")
        ends = np.searchsorted(heads, inner[1:])
        kinds = np.insert(classes()[points], ends, END)
        starts = token_starts(np.insert(points, ends, 0), kinds)
        # With one END after each row, every row's tokens end where the next one starts.
        at = np.insert(heads, ends, inner[1:])[starts]
        closing = np.searchsorted(np.flatnonzero(starts), ends + np.arange(len(ends))).tolist()
        raw, at = part.tobytes(), at.tolist()
        found = [raw[a:b] for a, b in zip(at, at[1:])]  # with one empty slice between rows
        yield [found[begin:stop] for begin, stop in zip([0, *[c + 1 for c in closing]], closing)]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every row's whole text by the ranks of a file: doc_id, n_tokens, ids, offsets.

    `ids` and `offsets` are binary, little-endian unsigned 32-bit numbers: the ids, and
    the byte of the text (in UTF-8) at which each token ends. Strings of special tokens
    are ordinary text. Null and empty texts have no tokens; repeated rows and null ids
    are kept; other columns of `docs` are not read. A row is held whole, with some
    twenty bytes of arrays a character; rows of a batch are scanned half a megabyte at a time.
    """
    def make():
        ranks = load_ranks(path)
        store = Merges(ranks)

        def step(batch: pa.RecordBatch) -> dict:
            data, bounds = text_bytes(batch.column("text"))
            ids = [row for rows in slices(data, bounds) for row in store.encode(rows)]
            numbers = [np.frombuffer(row, "<u4") for row in ids]
            return {"doc_id": batch.column("doc_id"), "n_tokens": [len(row) for row in numbers], "ids": ids,
                    "offsets": [np.cumsum(ranks.lengths[row]).astype("<u4").tobytes() for row in numbers]}

        return step

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(source.dtypes)["doc_id"]
    return map_batches(source, make, f"doc_id {kind}, n_tokens bigint, ids binary, offsets binary")


def decode(encoded: DataFrame, path: str, first: str | None = None, last: str | None = None,
           keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The bytes of the tokens of `encode`, as column `decoded` behind the columns `keep`.

    `first` and `last` may name integer columns: then just the tokens from `first`
    (counted from 0) up to before `last` are decoded, cut to those there are; a null
    stands for the row's start or end. Tokens are written to the places that their
    offsets give. A row whose ids are null gives null; ids that are not in the file,
    or do not fit the offsets, raise a ValueError.
    """
    def make():
        ranks = load_ranks(path)
        flat, begins, lengths = ranks.flat, ranks.begins, ranks.lengths

        def one(ids: bytes | None, offsets: bytes | None, low: int | None, high: int | None) -> bytes | None:
            if ids is None:
                return None
            tokens = np.frombuffer(ids, "<u4")
            ends = np.frombuffer(offsets or b"", "<u4").astype(np.int64)
            if len(ends) != len(tokens) or (len(tokens) and (tokens.max() >= len(lengths) or (
                    np.diff(ends, prepend=0) != lengths[tokens]).any())):
                raise ValueError("ids and offsets do not belong to this vocabulary")
            low = 0 if low is None else max(0, low)
            tokens, ends = tokens[low:high], ends[low:high]
            if not len(tokens):
                return b""
            places = ends - lengths[tokens]
            total = int(ends[-1] - places[0])
            return flat[np.repeat(begins[:-1][tokens] - (places - places[0]), lengths[tokens]) + np.arange(total)].tobytes()

        def step(batch: pa.RecordBatch) -> dict:
            columns = [batch.column(c).to_pylist() for c in ("__ids", "__offsets", "__first", "__last")]
            return {**{c: batch.column(c) for c in keep}, "decoded": [one(*row) for row in zip(*columns)]}

        return step

    def place(name: str | None):
        return (F.lit(None) if name is None else F.when(F.col(f"`{name}`") < 0, 0).otherwise(F.col(f"`{name}`"))).cast("bigint")

    kinds = dict(encoded.dtypes)
    source = encoded.select(*[F.col(f"`{c}`") for c in keep], F.col("ids").alias("__ids"),
                            F.col("offsets").alias("__offsets"), place(first).alias("__first"), place(last).alias("__last"))
    return map_batches(source, make, "".join(f"`{c}` {kinds[c]}, " for c in keep) + "decoded binary")
