import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuslink.llm import byte_bpe, queries
from corpuslink.llm.batches import text_bytes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = [*"abcABCstmdrevl''''  \n\t ,.!?012²½ªéÉßİΣσς…—漢字🙂\x00\x1c\x85\xa0  _&%#", "'s", "'ll", "'LL", "don't",
          "<|endoftext|>", "  \n\n", "é", "ᲊ", "'re", "'ve", "ভাষা", "한국어"]


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.load_ranks(PATH).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_here(texts):
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    store = byte_bpe.Merges(byte_bpe.load_ranks(PATH))
    return [np.frombuffer(ids, "<u4").tolist() for rows in byte_bpe.slices(data, bounds) for ids in store.encode(rows)]


def mixed(n, seed, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("stretch,group,block", [(1 << 20, 1 << 19, 128), (7, 100, 4), (1, 1, 2)])
def test_ids_are_the_librarys(library, monkeypatch, stretch, group, block):
    monkeypatch.setattr(byte_bpe, "STRETCH", stretch)
    monkeypatch.setattr(byte_bpe, "GROUP", group)
    monkeypatch.setattr(byte_bpe, "BLOCK", block)
    texts = [*mixed(1500, 1), *mixed(3, 2, 4000), "a" * 3000, "", " ", "  ", "'", "' 's", "x y" * 900]
    assert ids_here(texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_texts(texts):
    ranks = byte_bpe.load_ranks(PATH).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ids_here(texts) == [library.encode_ordinary(t) for t in texts]


def test_long_slices_and_a_small_store(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STORE_BYTES", 500)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdeé漢") for _ in range(n)) for n in (47, 48, 49, 300, 20_000)] * 3
    assert ids_here(texts) == [library.encode_ordinary(t) for t in texts]


def test_scan_composes_all_functions_before():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 8, 1000)
    got = byte_bpe.FUNCTIONS[byte_bpe.scan(byte_bpe.OF_SYMBOL[symbols]), byte_bpe.OPEN]
    state, want = byte_bpe.OPEN, []
    for symbol in symbols:
        want.append(state := byte_bpe._after(state, symbol))
    assert got.tolist() == want


def test_round_trip_offsets_and_parts(spark, docs, library):
    rows = list(enumerate([*mixed(200, 6), None, ""])) + [(None, "null id"), (3, "again"), (3, "again")]
    encoded = byte_bpe.encode(docs(rows), PATH).cache()
    assert encoded.columns == ["doc_id", "n_tokens", "ids", "offsets"]
    whole = byte_bpe.decode(encoded, PATH).collect()
    assert sorted(map(repr, ((r.doc_id, bytes(r.decoded)) for r in whole))) == sorted(
        map(repr, ((i, (t or "").encode()) for i, t in rows)))
    part = encoded.withColumns({"a": F.lit(2), "b": F.when(F.col("doc_id") % 2 == 0, 5)})
    for r in byte_bpe.decode(part, PATH, "a", "b", keep=("ids", "offsets", "b")).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert bytes(r.decoded) == library.decode_bytes(ids[2:r.b])
        assert np.frombuffer(r.offsets, "<u4").tolist() == np.cumsum([len(library.decode_bytes([i])) for i in ids]).tolist()


def test_wrong_offsets_are_refused(docs):
    encoded = byte_bpe.encode(docs([(1, "some words")]), PATH)
    with pytest.raises(Exception, match="do not belong"):
        byte_bpe.decode(encoded.withColumn("offsets", F.lit(b"\x01\0\0\0")), PATH).collect()


def test_null_ids_and_an_empty_table(docs, empty):
    encoded = byte_bpe.encode(docs([(1, "x")]), PATH)
    assert byte_bpe.decode(encoded.withColumn("ids", F.lit(None).cast("binary")), PATH).first().decoded is None
    assert byte_bpe.decode(byte_bpe.encode(empty, PATH), PATH).count() == 0


def test_the_query_agrees_with_the_library(spark, docs, tmp_path, library):
    rows = list(enumerate(mixed(60, 7)))
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.byte_bpe_round_trip(spark, str(tmp_path)).collect()}
    for i, t in rows:
        ids = library.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(t.encode()).hexdigest())
