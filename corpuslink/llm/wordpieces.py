"""Byte-level BPE by the tokenizers library, with the work shared between equal words.

Pre-tokens never cross certain places in a text (a space before a word, or any
white space where that is dropped). A text is cut there, and the library is asked
once per task for each different part. Parts of plain Latin script are cut into
pre-tokens here and given to the library's BPE model; all other parts go through
the library's whole `encode`. Where white space is dropped, plain Latin text is cut
into pre-tokens without being cut into words first.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from sys import getsizeof

from tokenizers import Tokenizer

#: White space of the Unicode standard, as the tokenizers' patterns understand it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters below U+0250 that are letters or numbers, in the sense of \p{L} and \p{N}.
NUMBER = "\\d\\xb2\\xb3\\xb9\\xbc-\\xbe"
LETTER = f"[^\\W{NUMBER}_]"
OTHER = f"(?:[^\\w{SPACE}]|_)"
CONTRACTION = "'(?:s|t|re|ve|m|ll|d)"
#: The two pre-token patterns of the files used here, for characters below U+0250.
SPACED = re.compile(f"{CONTRACTION}| ?{LETTER}+| ?[{NUMBER}]+| ?{OTHER}+|[{SPACE}]+")
#: The second with its letters listed, which is faster; lower case leads two letters beyond U+0250.
_LETTERS = "".join(sorted({c for k in range(0x250) for c in chr(k) + chr(k).lower() if c.isalpha()}))
_NUMBERS = NUMBER.replace("\\d", "0-9")
DROPPED = re.compile(f"{CONTRACTION}|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}{SPACE}]+")
RARE = re.compile("[\\x00-\\x08\\x0e-\\x1f\\x7f-\\x9f\\u0250-\\U0010ffff]")
COMMON = bytes(k for k in range(256) if not RARE.match(chr(k)))

#: Bytes of a task's store, the longest key that it keeps, and bytes of an entry's place in a table that has room.
STORE_BYTES, LONGEST, PLACE = 64 << 20, 64, 100


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Store(dict):
    """Values by key, made when first asked for; what was asked for lately is kept.

    When the entries fill half of the bytes they become the older half, and those of the
    older half before are dropped unless asked for again: words that recur outlive the many
    that occur once. An entry is counted as its key and value are in memory, with its place in
    the table. Long keys, such as texts of a script without spaces, are not kept.
    """

    def __init__(self, make):
        self._make, self._bytes, self._older = make, 0, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(key) <= LONGEST:
            size = PLACE + getsizeof(key) + getsizeof(value)
            self._bytes += size
            if 2 * self._bytes > STORE_BYTES:
                self._older = dict(self)
                self.clear()
                self._bytes = size
            self[key] = value
        return value


def portions(text: str, most: int = 16_384) -> Iterator[str]:
    """The text cut at blanks into parts of at most `most` characters; longer ones where no blank is."""
    at = 0
    while len(text) - at > most:
        end = text.rfind(" ", at + 1, at + most)
        if end < 0:
            end = text.find(" ", at + most)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def piece_ids(model) -> Callable[[str], bytes]:
    """Function from a pre-token to its packed ids by a byte-level model."""
    letters = byte_letters()

    def ids(piece: str) -> bytes:
        spelt = piece if piece.isascii() and piece.isalpha() else \
            piece.encode().decode("latin-1").translate(letters)
        return packed([t.id for t in model.tokenize(spelt)])

    return ids


class WordPieces:
    """Token ids of parts of texts; `lower` for files that lower-case and drop white space."""

    def __init__(self, path: str, lower: bool):
        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._lower, self._cut = lower, (DROPPED if lower else SPACED)
        self._odd = re.compile("|".join([RARE.pattern, *map(re.escape, self._special)]))
        # The store does not know this object: without a cycle, all is freed when a task ends.
        self._pieces = Store(piece_ids(self._tokenizer.model))

    @property
    def library(self) -> Tokenizer:
        return self._tokenizer

    @property
    def special(self) -> list[str]:
        return self._special

    def whole(self, text: str) -> list[int]:
        """The library's ids of a whole text."""
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def plain(self, part: str) -> bool:
        """Whether a part, of many characters, is cut into pre-tokens here, and not by the library."""
        try:
            rare = part.encode("latin-1").translate(None, COMMON)  # much faster than the pattern
        except UnicodeEncodeError:
            rare = RARE.search(part)
        return not rare and not any(s in part for s in self._special)

    def ids(self, part: str) -> bytes:
        """The library's ids, packed, of a part whose ends no pre-token crosses."""
        if self._odd.search(part):
            return packed(self.whole(part))
        return self.plain_ids(part)

    def plain_ids(self, part: str) -> bytes:
        """The same for a part known to be plain."""
        if self._lower:
            part = part.lower()
        return b"".join(map(self._pieces.__getitem__, self._cut.findall(part)))
