import random
import re
from collections import Counter

import numpy as np
import pytest

from corpuslink.llm import collocations


def brute(rows, least, top, inside=50, most=3):
    counts, totals = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            totals[lang] += len(w)
            for n in range(1, most + 1):
                counts.update((lang, tuple(w[k:k + n])) for k in range(len(w) - n + 1))
    kept = {c: f for c, f in counts.items() if len(c[1]) > 1 and f >= least}
    out = {}
    for (lang, p), a in kept.items():
        if any(lang == other and len(q) > len(p) and 100 * f >= inside * a and
               any(q[k:k + len(p)] == p for k in range(len(q) - len(p) + 1)) for (other, q), f in kept.items()):
            continue
        score, _, l, r = min((10 ** 6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]],
                              counts[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, k, p.decode(), -a, l, r, totals[lang], -s) for lang, found in out.items()
                  for k, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def make_rows(seed, n):
    rng = random.Random(seed)
    words = ["a", "A", "b", "the", "Of", "é", "É", "x\xa0y", "漢字", "c", "\x00", "new", "york", "City"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!", " ? "]
    texts = ["".join(rng.choice(words[:rng.choice((3, 8, 14))]) + rng.choice(gaps) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    texts += ["new york city new york city", None, "", " \t ", "...", "the " * 500]
    return [(t, rng.choice(["en", "en", "fr", None])) for t in texts] + [(texts[0], "en")] * 3


def frame(spark, rows):
    return spark.createDataFrame([(t, g, 1, "x", 2) for t, g in rows], "text string, lang string, word int, rests string, f int").repartition(5)


@pytest.mark.parametrize("entries,least,top", [(1_000_000, 10, 2000), (30, 3, 7), (1, 1, 50)])
def test_phrases_agree_with_brute_force(spark, entries, least, top):
    rows = make_rows(entries, 150 if least > 1 else 25)
    got = collocations.top_phrases(frame(spark, rows), least=least, top=top, entries=entries).collect()
    assert sorted(map(tuple, got)) == brute(rows, least, top)


def test_pairs_alone(spark):
    rows = make_rows(5, 60)
    got = collocations.top_phrases(frame(spark, rows), most=2).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, 2000, most=2)
    with pytest.raises(ValueError):
        collocations.top_phrases(frame(spark, rows), most=4)


def test_no_rows_and_no_candidates(spark):
    assert collocations.top_phrases(frame(spark, [("one two", "en")]).where("false")).count() == 0
    assert collocations.top_phrases(frame(spark, [("one two", "en"), (None, None)])).count() == 0


def test_hot_first_words_are_dealt_over_slots(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_SHARE", 50)
    monkeypatch.setattr(collocations, "SHARE", 1)
    rows = make_rows(11, 200)
    docs = frame(spark, rows)
    words = collocations.word_counts(docs)
    got = {(r.lang, r.phrase): r.f for r in collocations.phrase_counts(docs, words, least=1, entries=300).collect()}
    assert got == {(g, p): a for g, _, p, a, *_ in brute(rows, 1, 10 ** 9, inside=10 ** 9)}


def test_many_words_are_numbered_anew(spark, monkeypatch):
    """Tasks start anew when they have numbered many words; workers are forked, so the limits are set in them."""
    rows = make_rows(8, 40)
    counter = collocations._PhraseCounts(3, 1, {}, 100)
    monkeypatch.setattr(collocations, "WORDS", 4)
    found = Counter()

    def take(out):
        for lang, phrases, counts in zip(*(out[c].to_pylist() for c in ("lang", "phrases", "counts"))):
            assert len(set(phrases.split("\n"))) == len(counts)
            found.update({(lang, x): c for x, c in zip(phrases.split("\n"), counts)})

    for text, lang in rows:
        batch = [w for w in (text or "").encode().translate(collocations._PLAIN).replace(b"\xff", b" \xff ").split(b" ")]
        counter.add(lang or "und", [*batch, b"\xff"])
        for out in counter.flush(False):
            take(out)
    for out in counter.flush(True):
        take(out)
    want = {(g, p): a for g, _, p, a, *_ in brute(rows, 1, 10 ** 9, inside=10 ** 9)}
    assert found == want


def test_containers_burst_and_whole_subtrees_are_spilled(monkeypatch):
    monkeypatch.setattr(collocations, "BURST", 8)
    monkeypatch.setattr(collocations, "LEVELS", (44, 42, 21))
    rng = np.random.default_rng(3)

    def size(node):
        return len(node) if type(node) is Counter else sum(map(size, node.values()))

    trie, want, spilled = collocations.HatTrie(), Counter(), Counter()
    for _ in range(30):
        a, b, c = rng.integers(1, 30, 400), rng.integers(1, 12, 400), rng.integers(0, 6, 400)
        codes = a << 42 | b << 21 | c
        want.update(codes.tolist())
        trie.add(codes)
        assert trie.total == sum(map(size, trie.roots.values()))
        if trie.total > 200 and (gone := trie.spill(100)) is not None:
            assert not {int(x) >> collocations.LEVELS[0] for x in gone[0]} & set(trie.roots)
            spilled.update(dict(zip(gone[0].tolist(), gone[1].tolist())))
            assert trie.total <= 100
    gone = trie.spill()
    spilled.update(dict(zip(gone[0].tolist(), gone[1].tolist())) if gone else {})
    assert spilled == want and trie.spill() is None

