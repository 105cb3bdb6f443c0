"""Token counts of whole texts; huge texts in overlapping chunks that are spliced."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpuslink.llm.batches import id_and_text, map_batches
from corpuslink.llm.wordpieces import SPACE, Store, WordPieces

#: A space with the word after it; white space but its last character; one character of it.
PART = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")

#: Characters after its end that may decide where a pre-token ends.
LOOK_AHEAD = 4


class Chunk:
    """The library's encoding of text[begin:end]: ids, and where its pre-tokens begin."""

    def __init__(self, tokenizer: Tokenizer, text: str, begin: int, end: int):
        encoding = tokenizer.encode(text[begin:end], add_special_tokens=False)
        self.begin, self.end = begin, end
        self.ids = np.array(encoding.ids, np.uint32)
        words = np.array(encoding.word_ids, np.int64)
        first = np.flatnonzero(np.diff(words, prepend=-1))  # the first token of each pre-token
        self.tokens, self.starts = first, begin + np.array(encoding.offsets, np.int64).reshape(-1, 2)[first, 0]

    def token_at(self, place: int) -> int:
        """The number of the token with which the pre-token at a place begins."""
        return int(self.tokens[np.searchsorted(self.starts, place)])


def stable_boundary(left: Chunk, right: Chunk, margin: int) -> int | None:
    """First place where both chunks begin a pre-token and from which their ids agree.

    What pre-tokens the text after such a place has depends on no text before it, and the
    left chunk has seen `margin` characters after it, which decide that a pre-token, or a
    special string, does end there. So the left chunk is right up to the place, and
    the right one after it. Up to the last such place the ids are compared as well.
    """
    # The first place of a chunk is no sign of a boundary: it is where it was cut.
    low = max(left.begin, right.begin)
    shared = np.intersect1d(left.starts, right.starts, assume_unique=True)
    shared = shared[(shared > low) & (shared <= left.end - margin)]
    if not len(shared):
        return None
    first, last = int(shared[0]), int(shared[-1])
    same = np.array_equal(left.ids[left.token_at(first):left.token_at(last)],
                          right.ids[right.token_at(first):right.token_at(last)])
    return first if same else None


def spliced_ids(tokenizer: Tokenizer, text: str, chunk: int, overlap: int, margin: int) -> Iterator[np.ndarray]:
    """Runs of ids that together are the ids of the whole text, never encoding it as a whole.

    Each chunk begins `overlap` characters before the end of the one before and takes over
    at their first stable boundary. If there is none, the overlap is doubled, and
    when it reaches back to the start of the chunk, the chunk itself is made twice as long.
    """
    left = Chunk(tokenizer, text, 0, min(chunk, len(text)))
    done = 0  # the place up to which ids are handed on
    while left.end < len(text):
        width, place = overlap, None
        while place is None and left.end - width > done:
            right = Chunk(tokenizer, text, left.end - width, min(len(text), left.end + chunk))
            place = stable_boundary(left, right, margin)
            if place is not None and place <= done:
                place = None
            width *= 2
        if place is None:
            left = Chunk(tokenizer, text, done, min(len(text), 2 * left.end - done))
            continue
        yield left.ids[left.token_at(done) if done > left.begin else 0:left.token_at(place)]
        left, done = right, place
    yield left.ids[left.token_at(done) if done > left.begin else 0:]


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = 32_768, overlap: int = 256) -> DataFrame:
    """Tokens of every whole text as the tokenizers library counts them.

    `tokenizer` is the path, on every executor, of a byte-level BPE file whose
    pre-tokens keep the space before a word. Returns doc_id, n_bytes and n_tokens,
    one row per input row, repeated or null ids included. Null and empty texts have
    0 bytes and 0 tokens. Texts of more than `chunk` characters are encoded by the library
    in chunks that overlap by `overlap` characters or more; the counts are those of
    the whole text. In shorter texts equal words are encoded once (`wordpieces.py`).
    Strings of special tokens inside a text count as one token each
    and part the text, as is the library's default. Nothing is shuffled.
    """
    def make():
        pieces = WordPieces(tokenizer, lower=False)
        counts = Store(lambda part: len(pieces.ids(part)) // 4)
        special = re.compile("|".join(map(re.escape, pieces.special)) or "(?!)")
        margin = max([LOOK_AHEAD, *map(len, pieces.special)])

        def count(text: str) -> int:
            if len(text) > chunk:
                return sum(map(len, spliced_ids(pieces.library, text, chunk, overlap, margin)))
            runs = special.split(text)
            return len(runs) - 1 + sum(sum(map(counts.__getitem__, PART.findall(run))) for run in runs)

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text")
            return {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"),
                    "n_tokens": [count(t.as_py() or "") if t.is_valid else 0 for t in texts]}

        return step

    kind = dict(docs.dtypes)[id_col]
    rows = id_and_text(docs, id_col, text_col).withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    return map_batches(rows, make, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
