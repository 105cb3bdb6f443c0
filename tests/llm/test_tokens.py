import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from corpuslink.llm import packing, token_counts, wordpieces
from corpuslink.llm.wordpieces import WordPieces, packed

PIECES = [*"abcABC'  \n\t ,.!?012²½ªéÉßİΣσς…—漢字🙂\x1c\x85\xa0 _&%#", "'s", "'ll", "'LL", "don't",
          "<|endoftext|>", "<|startoftext|>", "<|endof", "  \n\n", "é"]


def texts(n, seed, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("chunk,overlap", [(32_768, 256), (90, 8), (31, 2)])
def test_counts_are_the_librarys(docs, chunk, overlap):
    rows = [*texts(400, 1), *texts(4, 2, 4000), "a" * 3000 + " " + "b" * 900, " " * 2000 + "x", "", None]
    rows = list(enumerate(rows)) + [(None, "a b"), (3, "twice"), (3, "twice")]
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = token_counts.count_tokens(docs(rows), path("byte_bpe_50k.json"), chunk=chunk, overlap=overlap).collect()
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                   for i, t in rows)
    assert Counter(map(tuple, got)) == want


def test_counts_of_an_empty_table(empty):
    out = token_counts.count_tokens(empty, path("byte_bpe_50k.json"))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens"] and out.count() == 0


LIBRARY = Tokenizer.from_file(path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(["a", " ", "\n", "'", "s", "l", "<", "1", "é", "漢"]), max_size=300), st.integers(16, 60))
def test_spliced_ids_are_the_ids_of_the_whole(text, chunk):
    got = [i for run in token_counts.spliced_ids(LIBRARY, text, chunk, 6, 4) for i in run]
    assert got == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["lorem  ipsum' dolor'll sit\n\n 12x " * 40, "w" * 700, " " * 500 + "x", "x<|endoftext|> y" * 60,
                                  "漢字かな" * 200, "a'" * 300, "🙂é " * 200])
def test_chunks_may_cut_words_white_space_and_special_strings(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    for chunk in range(40, 75):
        got = [i for run in token_counts.spliced_ids(LIBRARY, text, chunk, 8, len("<|endoftext|>")) for i in run]
        assert got == want


def test_overlap_widens_where_no_boundary_is_found(monkeypatch):
    made = []
    real = token_counts.Chunk
    monkeypatch.setattr(token_counts, "Chunk", lambda t, text, a, b: made.append((a, b)) or real(t, text, a, b))
    text = "ab " * 30 + "w" * 150 + " cd" * 60
    got = [i for run in token_counts.spliced_ids(LIBRARY, text, 100, 8, 4) for i in run]
    assert got == LIBRARY.encode(text, add_special_tokens=False).ids
    assert (92, 200) in made and (84, 200) in made and max(b - a for a, b in made) < len(text)


def test_stores_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(wordpieces, "STORE_BYTES", 1000)
    store = wordpieces.Store(len)
    assert [store["x" * k] for k in range(1, 100)] == list(range(1, 100))
    assert len(store) <= 5 and max(map(len, store)) <= wordpieces.LONGEST


def test_words_that_recur_outlive_those_that_occur_once(monkeypatch):
    monkeypatch.setattr(wordpieces, "STORE_BYTES", 20_000)
    made = Counter()
    store = wordpieces.Store(lambda k: made.update([k]) or k.encode())
    for k in range(5_000):
        assert store["the"] == b"the" and store[f"once{k}"] == f"once{k}".encode()
    assert made["the"] == 1 and len(made) == made.total() == 5_001 and len(store) + len(store._older) < 200


def test_plain_text_is_not_cut_into_words(docs, monkeypatch):
    asked = []
    real = packing.Store
    monkeypatch.setattr(packing, "Store", lambda make: real(lambda w: asked.append(w) or make(w)))
    rows = [(0, "Ünter den Linden, it's 12\xa0½ “quoted” İzmir ȺȾ. " * 3), (1, "plain words' don't, ***\n\t|x|_y"), (2, "")]
    monkeypatch.setattr(packing, "map_batches", lambda df, make, schema: make())
    step = packing.token_pieces(docs(rows), path("word_bpe_49k.json"))
    out = step(pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    assert out["ids"] == [packed([*library.encode(t, add_special_tokens=False).ids, 1]) for _, t in rows]
    assert "Linden," in asked and "words'" not in asked


def test_plain_parts_are_those_without_rare_characters_or_special_strings():
    pieces = WordPieces(path("word_bpe_49k.json"), lower=True)
    for c in [*map(chr, range(0x300)), "€", "漢", "🙂", "\ud7ff", "<|endoftext|>", "<|endoftext|"]:
        rare = wordpieces.RARE.search(c) or c == "<|endoftext|>"
        assert pieces.plain(f"ab {c} cd") == pieces.plain(f"ł {c}") == (not rare)


def test_portions_are_whole_and_cut_at_blanks():
    for text in ("", "a", "ab cd", "x" * 50, "ab " * 40, " " * 30, "x" * 30 + " y" * 30 + "z" * 30):
        for most in (1, 2, 7, 100):
            got = list(wordpieces.portions(text, most))
            assert "".join(got) == text and all(p.startswith(" ") for p in got[1:])
            assert all(len(p) <= most or " " not in p[1:most] for p in got)


def test_listed_letters_are_those_of_the_pattern():
    named = re.compile(f"{wordpieces.CONTRACTION}|{wordpieces.LETTER}+|[{wordpieces.NUMBER}]|{wordpieces.OTHER}+")
    for a in range(0x250):
        low = f"x{chr(a)}1{chr(a)}.{chr(a)}{chr(a)}".lower()
        if not wordpieces.RARE.search(chr(a)):
            assert wordpieces.DROPPED.findall(low) == named.findall(low)


def test_pieces_hold_the_librarys_ids(docs):
    rows = list(enumerate([*texts(400, 3), "", None, "<|endoftext|>", "ΑΣ ΑΣ"])) + [(None, "x"), (2, "again")]
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    got = packing.token_pieces(docs(rows), path("word_bpe_49k.json"), size=7).collect()
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 7):
            want[i, k // 7, k, len(ids[k:k + 7]), zlib.crc32(np.array(ids[k:k + 7], "<u4"))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) == want


def test_whole_and_parted_ids_agree():
    pieces = WordPieces(path("word_bpe_49k.json"), lower=True)
    for word in ("Don't", "x<|endoftext|>y", "½²a_b", "İzmir", "a\x1cb", "..."):
        assert pieces.ids(word) == packed(pieces.whole(word))


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1))
def test_bins_hold_everything_and_nothing_overflows(counts):
    groups = packing.plan_bins(counts, 60)
    held = Counter()
    for bins, items in groups:
        assert bins > 0 and sum(n * per for n, per in items) <= 60
        for n, per in items:
            held[n] += bins * per
    assert held == Counter(counts)


def best_fit(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else size
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return len(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_plan_needs_as_many_bins_as_best_fit_decreasing(lengths):
    assert sum(b for b, _ in packing.plan_bins(Counter(lengths), 30)) == best_fit(lengths, 30)


def test_sequences_have_no_gap(spark, docs):
    rng = random.Random(5)
    lengths = [rng.choice([3, 3, 3, 10, 17, 32]) for _ in range(500)]
    pieces = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id long, length int").repartition(7)
    got = packing.pack(pieces, size=32).toPandas()
    assert sorted(got["doc_id"]) == list(range(500))
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == [0, *g["length"].cumsum()[:-1]] and g["length"].sum() <= 32
    assert got["sequence_id"].nunique() == best_fit(lengths, 32)
    assert packing.pack(pieces.limit(0)).count() == 0
