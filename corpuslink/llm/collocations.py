"""Phrase collocations: n-grams counted in HAT-tries that spill sorted runs, scored by exact association."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpuslink.llm.batches import row_groups, text_bytes
from corpuslink.operators.scale import materialize

#: Bits of a word's number inside a task; three numbers make the code of a phrase.
BITS = 21
MASK = (1 << BITS) - 1
#: Bits of a code below each level of the trie: ranges of 256 first words, first words, second words.
LEVELS = (2 * BITS + 8, 2 * BITS, BITS)
#: Phrases a task counts before it spills, words and their bytes before it starts anew.
ENTRIES, WORDS, WORD_BYTES = 350_000, 1 << 19, 16 << 20
#: Bytes of text after which counts of words are handed out.
READ = 128 << 20
#: Phrases in one hash container before it bursts into a node of the next level.
BURST = 16_384
#: Bytes of text that are cut into words at a time, codes that are added at a time, entries and bytes of a row of a run.
GROUP, CODES, RUN_ROWS, RUN_BYTES = 1 << 20, 1 << 18, 4_096, 1 << 18
#: Ranges of first words, words of text for which a range has a slot, and occurrences of a hot word for which it has one.
#: The number of ranges is fixed, so that the rows of runs grow with the tasks alone.
RANGES, SHARE, HOT_SHARE = 1 << 12, 1 << 27, 1 << 20
#: A word that holds more than this part of all words has its phrases dealt over several partitions.
HOT = 10_000
#: Ranges of hash among which a language's best phrases are first sought.
SALTS = 64

#: A-Z in lower case, tabs as blanks, all that ends a piece as a byte that no text has.
_PLAIN = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b"\xff"


class _Numbers(dict):
    """Numbers of words, from 1, in the order of their coming, and their hashes; the end of a piece is 0."""

    def __init__(self):
        super().__init__({_END: 0})
        self.size, self.hashes = 0, [0]

    def __missing__(self, word: bytes) -> int:
        self.size += len(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, 42))
        number = self[word] = len(self)
        return number


class HatTrie:
    """Counts of phrases of up to three word numbers.

    Hash containers below a shallow trie. At first a container holds all phrases whose
    first words lie in a range; one that has grown beyond `BURST` bursts into a node
    with a container for each first word, and such a one into a node with one for each
    second word. Whole subtrees are handed out, the largest first.
    """

    def __init__(self):
        self.roots: dict[int, Counter | dict] = {}
        self.sizes: Counter = Counter()
        self.total = 0

    def add(self, codes: np.ndarray) -> None:
        """Counts codes (three numbers in one, 0 for none)."""
        self.total += self._add(self.roots, np.sort(codes), 0, self.sizes)

    def _add(self, nodes: dict, codes: np.ndarray, level: int, sizes: Counter | None = None) -> int:
        """How many phrases below `nodes` are new."""
        keys = codes >> LEVELS[level]
        cuts = np.flatnonzero(np.diff(keys, prepend=-1, append=-1)).tolist()
        rests, keys, new = codes & (1 << LEVELS[level]) - 1, keys[cuts[:-1]].tolist(), 0
        for key, a, b in zip(keys, cuts, cuts[1:]):
            node = nodes.get(key)
            if type(node) is dict:
                more = self._add(node, rests[a:b], level + 1)
            else:
                if node is None:
                    node = nodes[key] = Counter()
                more = -len(node)
                node.update(rests[a:b].tolist())
                more += len(node)
                if len(node) > BURST and level + 1 < len(LEVELS):
                    nodes[key] = self._burst(node, level + 1)
            new += more
            if sizes is not None:
                sizes[key] += more
        return new

    @staticmethod
    def _burst(node: Counter, level: int) -> dict:
        below: dict[int, Counter] = {}
        mask = (1 << LEVELS[level]) - 1
        for rest, n in node.items():
            key = rest >> LEVELS[level]
            if key not in below:
                below[key] = Counter()
            below[key][rest & mask] = n
        return below

    def _gather(self, node: Counter | dict, above: int, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if type(node) is dict:
            for key, child in node.items():
                yield from self._gather(child, above | key << LEVELS[level + 1], level + 1)
        else:
            yield (np.fromiter(node.keys(), np.int64, len(node)) | above, np.fromiter(node.values(), np.int64, len(node)))

    def spill(self, left: int = 0) -> tuple[np.ndarray, np.ndarray] | None:
        """Codes and counts of the subtrees that must go for at most `left` phrases to stay, if any."""
        if self.total <= left:
            return None
        gone: list[tuple[np.ndarray, np.ndarray]] = []
        for key, size in self.sizes.most_common():
            if self.total <= left:
                break
            gone += self._gather(self.roots.pop(key), key << LEVELS[0], 0)
            del self.sizes[key]
            self.total -= size
        return tuple(map(np.concatenate, zip(*gone)))


def _words(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Words of a batch by language, the end of each piece marked; a text of any length is one list."""
    data, bounds = text_bytes(batch.column("text"))
    langs = batch.column("lang").fill_null("und").to_pylist()
    for first, last in row_groups(bounds, GROUP):
        texts: dict[str, list[bytes]] = {}
        for row in range(first, last):
            texts.setdefault(langs[row], []).append(data[bounds[row]:bounds[row + 1]].tobytes())
        for lang, parts in texts.items():
            yield lang, _END.join(parts).translate(_PLAIN).replace(_END, b" \xff ").split(b" ")


def _codes(numbers: np.ndarray, most: int) -> np.ndarray:
    """Codes of all phrases of two to `most` words within pieces."""
    first, second = numbers[:-1], numbers[1:]
    pair = (first > 0) & (second > 0)
    codes = [(first[pair] << 2 * BITS) | (second[pair] << BITS)]
    if most > 2:
        three = pair[:-1] & (numbers[2:] > 0)
        codes.append((first[:-1][three] << 2 * BITS) | (second[:-1][three] << BITS) | numbers[2:][three])
    return np.concatenate(codes)


def _runs(lang: str, numbers: _Numbers, codes: np.ndarray, counts: np.ndarray, usual: int, slots: dict) -> dict:
    """Rows of sorted runs: a prefix partition, its phrases and their counts, in the order of the words' hashes.

    The partition is the range of the first word's hash, and a slot of the other words: one of `usual`
    slots, or of as many as a hot first word has.
    """
    hashes, words = np.array(numbers.hashes, np.uint64), list(numbers)
    order = np.argsort(hashes[1:])
    rank = np.zeros(len(words), np.int64)
    rank[1 + order] = np.arange(1, len(words))
    spelt = pa.array(words, pa.binary()).slice(1).take(pa.array(order)).cast(pa.string())
    hashes[1:] = hashes[1:][order]
    codes = rank[codes >> 2 * BITS] << 2 * BITS | rank[codes >> BITS & MASK] << BITS | rank[codes & MASK]
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    a, b, c = codes >> 2 * BITS, codes >> BITS & MASK, codes & MASK
    part = (hashes[a] >> np.uint64(33)).astype(np.int64) * RANGES >> 31
    slot = np.zeros(len(a), np.int64)
    if slots or usual > 1:
        spread = np.array([1, *[slots.get((lang, h), usual) for h in hashes[1:].tolist()]], np.uint64)[a]
        slot = (((hashes[b] * np.uint64(0x9E3779B97F4A7C15) + hashes[c]) >> np.uint64(20)) % spread).astype(np.int64)
        if slot.any():
            order = np.lexsort((slot, part))
            a, b, c, part, slot, counts = (x[order] for x in (a, b, c, part, slot, counts))
    third = pa.array(np.maximum(c - 1, 0), mask=c == 0)
    phrases = pc.binary_join_element_wise(spelt.take(pa.array(a - 1)), spelt.take(pa.array(b - 1)), spelt.take(third), " ",
                                          null_handling="skip")
    # A run ends with its partition, and with so many rows or bytes.
    sizes = np.cumsum(pc.binary_length(phrases).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    cut = np.arange(len(a)) % RUN_ROWS == 0
    cut[1:] |= (part[1:] != part[:-1]) | (slot[1:] != slot[:-1]) | (sizes[1:] // RUN_BYTES != sizes[:-1] // RUN_BYTES)
    starts = np.flatnonzero(cut)
    offsets = pa.array(np.append(starts, len(a)).astype(np.int32))
    return {"lang": pa.array([lang] * len(starts), pa.string()), "part": pa.array(part[starts]), "slot": pa.array(slot[starts]),
            "phrases": pc.binary_join(pa.ListArray.from_arrays(offsets, phrases), "\n"),
            "counts": pa.ListArray.from_arrays(offsets, pa.array(counts))}


def _counted(docs: DataFrame, schema: str, make) -> DataFrame:
    """Runs `make()`, an object with add(lang, words) and flush(last), over the batches of each task."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = make()

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            for out in counter.flush(last):
                table = pa.Table.from_arrays([out[f.name].cast(f.type) for f in arrow], schema=arrow)
                yield from table.to_batches(max_chunksize=2_000)

        for batch in batches:
            for lang, words in _words(batch):
                counter.add(lang, words)
                yield from rows(False)
        yield from rows(True)

    return docs.mapInArrow(run, schema)


class _WordCounts:
    """Counts of words; all are handed out when there are many, or much text was read."""

    def __init__(self):
        self.counts: dict[str, Counter] = {}
        self.read = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        self.counts.setdefault(lang, Counter()).update(words)
        self.read += sum(map(len, words))

    def flush(self, last: bool) -> Iterator[dict]:
        if not last and self.read < READ and sum(map(len, self.counts.values())) < WORDS:
            return
        for lang, found in self.counts.items():
            for no_word in (b"", _END):
                found.pop(no_word, None)
            yield {"lang": pa.array([lang] * len(found), pa.string()),
                   "word": pa.array(list(found), pa.binary()).cast(pa.string()), "f": pa.array(list(found.values()), pa.int64())}
        self.counts, self.read = {}, 0


class _PhraseCounts:
    """A trie for each language, and one numbering of words for all."""

    def __init__(self, most: int, usual: int, slots: dict, entries: int):
        self.most, self.usual, self.slots, self.entries = most, usual, slots, entries
        self.numbers, self.tries, self.waiting = _Numbers(), {}, {}

    def add(self, lang: str, words: list[bytes]) -> None:
        """Codes wait until there are many, as few large steps take less than many small ones."""
        numbers = np.fromiter(map(self.numbers.__getitem__, filter(None, words)), np.int64)
        waiting = self.waiting.setdefault(lang, [])
        waiting.append(_codes(numbers, self.most))
        if sum(map(len, waiting)) > CODES:
            self._count(lang)

    def _count(self, lang: str) -> None:
        if lang not in self.tries:
            self.tries[lang] = HatTrie()
        self.tries[lang].add(np.concatenate(self.waiting.pop(lang)))

    def flush(self, last: bool) -> Iterator[dict]:
        waiting = sum(len(c) for codes in self.waiting.values() for c in codes)
        anew = last or len(self.numbers) > WORDS or self.numbers.size > WORD_BYTES
        if anew or waiting > 2 * CODES:  # of many languages
            for lang in list(self.waiting):
                self._count(lang)
        total, most = sum(t.total for t in self.tries.values()), 0 if anew else self.entries // 2
        for lang, trie in sorted(self.tries.items(), key=lambda t: -t[1].total) if anew or total > self.entries else ():
            before = trie.total
            if total > most and (gone := trie.spill(max(0, most - (total - before)))) is not None:
                yield _runs(lang, self.numbers, *gone, self.usual, self.slots)
            total -= before - trie.total
        if anew:
            self.numbers, self.tries = _Numbers(), {}


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Occurrences of every word in every language: lang, word, f."""
    source = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    parts = _counted(source, "lang string, word string, f bigint", _WordCounts)
    return parts.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def phrase_counts(docs: DataFrame, words: DataFrame, most: int = 3, least: int = 10, lang_col: str = "lang",
                  text_col: str = "text", entries: int = ENTRIES) -> DataFrame:
    """All phrases of 2 to `most` (2 or 3) words with `least` occurrences or more: lang, phrase, f.

    A task counts in tries and spills subtrees as sorted runs. Runs are dealt out by
    language and prefix partition (a range of first words, in slots where there is much
    text) and merged there. `words` (see `word_counts`) tells which first words are hot:
    at most `HOT` can hold more than that part of all words, and their phrases are dealt
    over as many slots as their share asks for.
    """
    if most not in (2, 3):
        raise ValueError("phrases have 2 or 3 words at most")
    total = words.agg(F.sum("f")).first()[0] or 0
    usual = 1 + total // (RANGES * SHARE)
    hot = words.where(F.col("f") * HOT > total).select("lang", F.xxhash64("word").alias("h"), "f").collect()  # HOT rows at most
    slots = {(r["lang"], r["h"] & (1 << 64) - 1): max(usual, 1 + r["f"] // max(HOT_SHARE, total >> 20)) for r in hot}
    slots = {word: n for word, n in slots.items() if n > usual}
    source = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    runs = _counted(source, "lang string, part bigint, slot bigint, phrases string, counts array<bigint>",
                    lambda: _PhraseCounts(most, usual, slots, entries))
    dealt = runs.repartition("lang", "part", "slot")
    lone = dealt.select("lang", "part", "slot", F.inline(F.arrays_zip(F.split("phrases", "\n").alias("phrase"), F.col("counts").alias("c"))))
    merged = lone.groupBy("lang", "part", "slot", "phrase").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
    return merged.select("lang", "phrase", "f")


def _part(words: str, start, length):
    return F.array_join(F.slice(words, start, length), " ")


def top_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = 3,
                least: int = 10, top: int = 2_000, inside: int = 50, entries: int = ENTRIES) -> DataFrame:
    """Each language's `top` phrases by association: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut at . , ; : ! ? and line ends into pieces, those at
    blanks and tabs into words. Phrases lie within a piece; overlapping occurrences
    count. A candidate has 2 to `most` words and occurs `least` times or more (a). Cut
    into two parts that occur l and r times it scores floor(10^6 a a / (l r)); the cut
    with the lowest score counts, the earliest of equals. Candidates that lie within
    a longer candidate with at least `inside` percent of their occurrences go. Ranks go by
    score, then a (both from the highest), then phrase in UTF-8 order; n counts all words of
    the language. Numbers are exact (decimals of 38 digits).

    A null language is `und`, a null text empty; repeated rows count each time, other
    columns are not read. Languages without candidates have no rows, nor has an empty table.
    """
    words = materialize(word_counts(docs, lang_col, text_col))
    phrases = materialize(phrase_counts(docs, words, most, least, lang_col, text_col, entries))
    parts = materialize(words.where(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), "f").union(phrases))
    split = phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    n_words = F.size("w")
    cuts = split.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), n_words - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part("w", F.lit(1), F.col("k")).alias("left"),
        _part("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    score = F.expr("1000000bd * wa * wa div (wl * wr)")
    scored = cuts.select("lang", "phrase", "a", "l", "r", "k", *[v.alias(f"w{c}") for c, v in wide.items()])
    scored = scored.select("lang", "phrase", F.struct(score.alias("score"), "k", "a", "l", "r").alias("cut"))
    scored = scored.groupBy("lang", "phrase").agg(F.min("cut").alias("cut")).select("lang", "phrase", "cut.*")

    longer = []
    for size in range(2, most):
        spans = split.where(n_words > size).select("lang", F.col("a").alias("longer"), "w", F.explode(
            F.sequence(F.lit(1), n_words - size + 1)).alias("at"))
        longer.append(spans.select("lang", _part("w", F.col("at"), F.lit(size)).alias("phrase"), "longer"))
    if longer:
        holds = reduce(DataFrame.union, longer).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(holds, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside)).drop("longer")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    few = scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    sums = words.groupBy("lang").agg(F.sum("f").alias("n"))
    out = ranked.join(sums, "lang")
    return out.select("lang", *[F.col(c).cast("bigint").alias(c) for c in ("rank",)], "phrase", "a", "l", "r", "n", "score")
