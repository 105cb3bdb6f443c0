import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslink.llm import line_templates, recompression, simhash
from corpuslink.operators import components


def plain_fingerprint(text):
    words = (text or "").lower().split()
    runs = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reached(n, linked):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(n)]


def test_fingerprints_and_components(docs):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefg") * 3 for _ in range(rng.randint(0, 6))) for _ in range(60)]
    rows = [(i, rng.choice([*base, None, "", " \t "])) for i in range(150)]
    got = {r.doc_id: (r.fingerprint & (1 << 64) - 1, r.component_id)
           for r in simhash.near_duplicates(docs(rows)).collect()}
    prints = [plain_fingerprint(t) for _, t in rows]
    root = smallest_reached(150, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert got == {i: (prints[i], root[i]) for i in range(150)}


def test_near_pairs_join_what_all_pairs_join(spark):
    rng = random.Random(8)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    values = {0, 1, 3, 7, 15}
    for s in seeds:
        for _ in range(12):
            s ^= 1 << rng.randrange(64) | 1 << rng.randrange(64) | (1 << rng.randrange(64)) * rng.randrange(2)
            values.add(s)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    got = {r.node: r.component for r in components.components(simhash.near_pairs(frame)).collect()}
    root = smallest_reached(len(values), lambda a, b: ((values[a] ^ values[b]) & (1 << 64) - 1).bit_count() <= 2)
    assert {v: got.get(v, v) for v in values} == {v: values[r] for v, r in zip(values, root)}
    assert len(set(root)) < len(values)


@pytest.mark.parametrize("radius,most", [(1, 64), (2, 16)])
def test_full_buckets_are_dealt_again(spark, radius, most):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(2)]
    values = {b ^ sum(1 << i for i in rng.sample(range(14), k)) for b in base for k in (0, 1, 2, 3, 5, 7) for _ in range(25)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    pairs = simhash.near_pairs(frame, radius, most).collect()
    assert all(((p.a ^ p.b) & (1 << 64) - 1).bit_count() <= 14 for p in pairs)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs)).collect()}
    root = smallest_reached(len(values), lambda a, b: ((values[a] ^ values[b]) & (1 << 64) - 1).bit_count() <= radius)
    assert {v: got.get(v, v) for v in values} == {v: values[r] for v, r in zip(values, root)}


@given(st.sets(st.integers(0, 63), max_size=3))
def test_some_covering_mask_avoids_any_few_bits(bits):
    assert any(not any(m >> b & 1 for b in bits) for m in simhash.covering_masks(3))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (2000, 2000)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{k: 1000 for k in range(1000, 1200)}}


def test_near_duplicates_of_odd_rows(docs, empty):
    assert simhash.near_duplicates(empty).count() == 0
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (7, None), (9, "")]
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs(rows)).collect())
    assert got == Counter([(None, 4), (4, 4), (4, 4), (7, 7), (9, 7)])


def test_recurring_lines_go_and_copies_stay(docs):
    rng = random.Random(2)

    def prose(n=9):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))

    rows = [(k, f"{prose()}\nPosted on day {k} by the editor\n{prose()}") for k in range(14)]
    copy = "\n".join(prose() for _ in range(4))
    rows += [(100 + k, copy) for k in range(30)]
    rows += [(200 + k, f"{prose()}\nPage written by {prose(1)} for all readers\n{prose()}") for k in range(14)]
    rows += [(300, None), (301, ""), (302, "Posted on day 5 by the editor"), (None, prose()), (303, prose()), (303, prose())]
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(docs(rows), keep=("lang", "text")).collect()}
    for k in range(14):
        lines = rows[k][1].split("\n")
        assert got[k].text == f"{lines[0]}\n{lines[2]}" and (got[k].n_lines, got[k].n_dropped) == (3, 1)
        assert got[200 + k].n_dropped == 1
    assert all(got[100 + k].text == copy for k in range(30))
    assert got[300].text is None and got[300].n_lines == 0 and got[301].text == "" and got[301].n_lines == 1
    assert got[302].text == "" and got[302].n_dropped == 1 and got[302].lang == "en"


def test_footer_heavy_pages_and_short_lines(docs):
    """Pages of twenty words of their own lose a four-line footer and "Read more", however they are spaced."""
    rng = random.Random(12)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))

    footer = [prose(9) for _ in range(4)]
    own = [prose(20) for _ in range(200)]
    rows = [(k, "\n".join([own[k], *footer, "Read more" if k % 2 else " Read \t more\r"])) for k in range(200)]
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(docs(rows)).collect()}
    assert all(got[k].text == own[k] and got[k].n_dropped == 5 for k in range(200))


def test_fields_and_their_literal_form_are_one_template(docs):
    rows = [(k, f"Visit number <*> of this year\nonly {k} here {'xyz'[k % 3] * (k + 3)}") for k in range(9)]
    rows += [(20 + k, f"Visit number {k} of this year") for k in range(3)]
    got = {r.doc_id: r.n_dropped for r in line_templates.drop_recurring_lines(docs(rows)).collect()}
    assert all(got[k] >= 1 for k in [*range(9), 20, 21, 22])


def test_lines_of_an_empty_table(empty):
    assert line_templates.drop_recurring_lines(empty).count() == 0


def without_repeats(rows, window):
    first = {}
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for p in range(len(w) - window + 1 if i is not None else 0):
            run = tuple(w[p:p + window])
            first[run] = min(i, first.get(run, i))
    out = Counter()
    for i, w in texts:
        gone = set()
        for p in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out[i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()] += 1
    return out


def test_repeats_are_those_of_brute_force(docs):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    passages = [some(rng.randint(45, 160)) for _ in range(5)]
    rows = []
    for i in range(160):
        kind = rng.random()
        if kind < 0.4:
            w = some(rng.randint(0, 80)) + rng.choice(passages) + some(rng.randint(0, 60))
        elif kind < 0.5:
            w = ["a"] * rng.randint(40, 200) + some(5)
        elif kind < 0.6:
            w = ["p", "q", "r"][:rng.randint(1, 3)] * rng.randint(20, 60) + some(rng.randint(0, 4))
        elif kind < 0.75 and rows:
            w = (rng.choice(rows)[1] or "").split()
            if w:
                w[rng.randrange(len(w))] = f"edit{i}"
        else:
            w = some(rng.randint(0, 300))
        rows.append((i if rng.random() > 0.03 else None, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(5, rows[9][1]), (9, rows[9][1]), (300, None), (301, ""), (302, "x" * 9000 + " y")]
    rng.shuffle(rows)
    few = [(None if i is None else i % 12, t) for i, t in rows if i is None or i < 150]  # ids of many different texts
    for window, rounds, rows in ((50, 4, rows), (12, 2, rows), (50, 4, few)):
        got = Counter(map(tuple, recompression.drop_repeats(docs(rows), window=window, rounds=rounds).collect()))
        assert got == without_repeats(rows, window)


def test_repeats_of_an_empty_table(empty):
    assert recompression.drop_repeats(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"ccc", b"dd"]), max_size=60), min_size=1, max_size=4))
def test_equal_windows_have_equal_keys(rows):
    texts = [b" ".join(r) for r in rows]
    bounds = np.cumsum([0, *map(len, texts)])
    names, first = recompression.word_names(np.frombuffer(b"".join(texts), np.uint8), bounds)
    key, _, start, count = recompression.segments(names, first, 8, 2)
    flat, seen = [w for r in rows for w in r], {}
    for k, s, n in zip(key, start, count):
        for p in range(s, s + n):
            assert seen.setdefault(tuple(flat[p:p + 8]), k) == k
    assert sum(count) == sum(max(0, len(r) - 7) for r in rows)
