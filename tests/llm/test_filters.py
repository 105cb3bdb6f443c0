import random
import re
import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.llm import contamination, html_blocks, language, secrets, topk

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_base_spans_are_those_of_the_patterns(docs, empty):
    rng = random.Random(5)
    parts = ["token", "TOKEN", "secret", "=", ":", " ", '"', "'", "abc123", "DEADBEEFdeadbeef", "AKIA", "é", "\n",
             "ABCDEFGHIJKLMNOP", "api_key", "ApiKey", "ſecret", "toKen", ".", "0123456789abcdef", "🙂"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    rows += [(2000, None), (None, "token=abcdefghijklmnop"), (2001, "x" * 200_000 + "f" * 16)]
    got = secrets.find_secrets(docs(rows)).collect()
    by_id = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        base = plain_spans(by_id[r.doc_id] or "")
        assert [tuple(s) for s in r.base] == base and set(base) <= {tuple(s) for s in r.spans}
    assert secrets.find_secrets(empty).count() == 0


def test_random_strings_are_found_and_words_are_not(docs):
    rng = random.Random(6)
    coded = string.ascii_letters + string.digits + "+/"
    keys = ["".join(rng.choice(coded) for _ in range(n)) for n in (20, 24, 32, 40, 64) for _ in range(8)]
    names = ["thisisalongwordwithoutanyspaces", "this-is-a-long-slug-for-an-article-2024", "A" * 40,
             "https//www/example/com/path/to/page", "2024-01-01-12-30-00-000001", "some_function_name_of_a_module"]
    rows = [(i, f"so {k}, he said") for i, k in enumerate(keys)]
    rows += [(1000 + i, f"see {n} here") for i, n in enumerate(names * 20)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(docs(rows)).collect()}
    hits = sum((3, secrets.KINDS.index("random"), 3 + len(k)) in got[i] for i, k in enumerate(keys))
    assert hits >= 0.9 * len(keys)
    assert not any(got[i] for i in got if i >= 1000)


def test_short_random_strings_are_tested_too(docs):
    rng = random.Random(16)
    coded = string.ascii_letters + string.digits
    keys = ["".join(rng.choice(coded) for _ in range(n)) for n in (12, 14, 16, 18, 19) for _ in range(20)]
    names = ["international", "understanding", "responsibilities", "some_function_name", "JavaScriptEngine", "2024-01-01-12-30"]
    rows = [(i, f"so {k}, he said") for i, k in enumerate(keys)] + [(1000 + i, f"see {n}") for i, n in enumerate(names * 20)]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs(rows)).collect()}
    assert sum(bool(got[i]) for i in range(len(keys))) > 0.7 * len(keys)
    assert not any(got[i] for i in got if i >= 1000)


def test_long_random_strings_are_spans_like_others(docs):
    rng = random.Random(26)
    coded = string.ascii_letters + string.digits + "+/"
    rows = [(n, "see " + "".join(rng.choice(coded) for _ in range(n)) + " token=abcdefghijklmnop") for n in (60, 800, 5000, 40_000)]
    for r in secrets.find_secrets(docs(rows)).collect():
        text = dict(rows)[r.doc_id]
        assert [tuple(s) for s in r.base] == plain_spans(text)
        assert (4, secrets.KINDS.index("random"), 4 + r.doc_id) in [tuple(s) for s in r.spans]


def test_longer_strings_need_less_evidence():
    bins = secrets.discovery_bins([(3, 20, 40), (8, 20, 40), (3, 0, 400)], 0.01)
    assert bins[8] <= bins[3] and secrets.discovery_bins([], 0.01)[0] > secrets.BINS


def language_rows(spark, n):
    rng = random.Random(7)
    vocabulary = {"en": "the of and that with from which this have was".split(),
                  "de": "der die und nicht mit dem eine auch auf zur".split(),
                  "fr": "le la et dans pour une avec que les des".split()}
    rows = [(i, " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randint(5, 60))), lang)
            for i in range(n) for lang in [rng.choice(list(vocabulary))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_on_rows_never_learned_from(spark):
    docs = language_rows(spark, 900)
    model = language.fit_languages(docs, per_language=150)
    got = docs.join(language.identify_languages(docs, model), "doc_id").withColumn("h", language.held_out("doc_id"))
    held = got.where("h").toPandas()
    assert len(held) > 200 and (held["lang"] == held["lang_pred"]).mean() > 0.98
    assert held["accepted"].mean() > 0.97 and held["score"].between(0, 1).all()


def test_a_hot_id_and_repeated_rows_neither_fill_nor_miss_the_draw(spark):
    docs = language_rows(spark, 900)
    hot = docs.where("lang = 'en'").withColumn("doc_id", F.lit(1).cast("long"))  # not held out
    one = docs.where("lang = 'de'").orderBy("doc_id").where(~language.held_out("doc_id")).limit(1)
    same = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3000)))).select(docs.columns)
    model = language.fit_languages(docs.where("lang = 'fr'").union(hot).union(same), per_language=50)
    assert model.langs == ["de", "en", "fr"]


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = language_rows(spark, 300)
    other = docs.withColumn("lang", F.when(language.held_out("doc_id"), "zz").otherwise(F.col("lang")))
    one, two = language.fit_languages(docs), language.fit_languages(other)
    assert one.langs == two.langs and np.array_equal(one.table, two.table)


def test_texts_without_letters_and_odd_rows(spark, docs, empty):
    model = language.fit_languages(language_rows(spark, 300))
    rows = [(1, None), (2, ""), (3, "12 !? 🙂"), (None, "the of and"), (4, "é"), (4, "é"), (5, "und " * 60_000)]
    got = language.identify_languages(docs(rows), model, keep=("lang", "n_tokens", "doc_id")).collect()
    assert len(got) == 7 and got[0].lang == "en"
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3)) and 0 <= r.score <= 1
        assert r.doc_id not in (1, 2, 3) or not r.accepted
    assert language.fit_languages(empty) is None
    assert {r.lang_pred for r in language.identify_languages(docs(rows), None).collect()} == {"und"}
    assert language.identify_languages(empty, model).count() == 0


@pytest.mark.parametrize("shard_rows,block_rows", [(4096, 4096), (60, 3)])
def test_top_products_are_those_of_all_pairs(spark, shard_rows, block_rows):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.25, 0.7]) for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(150)]
    rows += [(2, None), (7, [1.0, None, 0.0, 0.0]), (9, [1.0, float("nan"), 0.0, 0.0]), (11, [float("inf")] * 4),
             (None, [1.0] * 4), (10, [1.0, 1.0]), (1, rows[1][1]), (0, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, vec array<float>").withColumn("rank", F.lit("x"))
    got = topk.top_products(frame, F.col("vec_id") % 10 == 0, k=5, vec_col="vec", shard_rows=shard_rows,
                            block_rows=block_rows).collect()
    sound = [(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for q, v in {r for r in sound if r[0] % 10 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q and len(w) == len(v))[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e9, 3.0]), (1, [1e9 + 1, 7.0]), (2, [-1e9, 1.0]), (3, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    got = {(r.vec_id, r.score) for r in topk.top_products(frame, F.col("vec_id") == 3, vec_col="vec").collect()}
    assert got == {(0, 0), (1, 0), (2, 0)}
    assert topk.top_products(frame.limit(0), F.lit(True), vec_col="vec").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var x="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="ad">Buy it now</div><article><h1>A title</h1><p><b>First &amp; long   line<br>of text<p>Second one</p>
<div class="comments"><p>I like it</p></div></article><form><p>Your name</p></form><footer>&copy; all</footer></body>"""


def test_blocks_of_broken_markup():
    found = html_blocks.blocks(PAGE)
    assert [b.text for b in found] == ["Home", "News", "Buy it now", "A title", "First & long line of text",
                                       "Second one", "I like it", "Your name", "© all"]
    assert [html_blocks.rule_label(b) for b in found] == [0, 0, 0, 1, 1, 1, 0, 0, 0]
    for odd in ("", "<", "<p", "</p></div>", "<!-- x", "<script>x", "a<b>c", "<a href='>'>x</a>", "&#xZZ; &nope"):
        html_blocks.blocks(odd)


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(0)
    model = html_blocks.Labeller()
    x, mask = html_blocks.padded([rng.normal(size=(n, html_blocks.INPUT)) for n in (3, 5)])
    y = (rng.random(mask.shape) > 0.5) * 1.0

    def loss():
        p = html_blocks.sigmoid(model.logits(x, mask)[0])
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    for name, grad in model.gradients(x, mask, y).items():
        at = tuple(rng.integers(n) for n in grad.shape)
        kept = model.w[name][at]
        model.w[name][at] = kept + 1e-5
        above = loss()
        model.w[name][at] = kept - 1e-5
        below = loss()
        model.w[name][at] = kept
        assert abs((above - below) / 2e-5 - grad[at]) < 1e-8


@pytest.mark.parametrize("page,want", [
    ('<p>one</p><svg viewBox="0"/><p>two</p>', ["one", "two"]), ("<p>one</p><noscript>x<p>two</p>", ["one", "x", "two"]),
    ("<p>one</p><select><p>two</p><script>x<p>gone</p>", ["one", "two"]), ("<p>a <b 'x</p><p>two</p>", ["a <b 'x", "two"]),
    ("<svg><text>x</text></svg>one<!-- <p>two</p>", ["one"]), ("<p>1 < 2 <3</p>a<b", ["1 < 2 <3", "a<b"]),
    ('<p title="a > b">one</p><![CDATA[two', ["one"])])
def test_nothing_is_lost_behind_odd_tags(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


def test_unquoted_values_do_not_close_and_broken_pages_are_read_once():
    assert [(b.text, b.linked) for b in html_blocks.blocks("<a href=/x/>word</a>")] == [("word", 4)]
    start = time.time()
    for part in ("a<b ", '<b ">" ', "<! ", "<svg>", "<aaaa", "</b '"):
        html_blocks.blocks(part * (1_000_000 // len(part)) + '">"')
    assert time.time() - start < 20


def test_main_text_of_pages(spark):
    rng = random.Random(9)

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))

    def page(main, extra):
        menu = "".join(f"<li><a href='/x'>{words(1)}</a></li>" for _ in range(5))
        paragraphs = [words(rng.randint(1, 40)) for _ in range(rng.randint(1, 8))]
        inner = "".join(f"<p>{p}</p>" for p in paragraphs)
        return (f"<html><body><nav><ul>{menu}</ul></nav>{extra}<{main}>{inner}</{main}>"
                f"<footer>{words(6)}</footer></body></html>"), "\n\n".join(paragraphs)

    made = [page("article", f"<div class='ad'>{words(8)}</div>") for _ in range(120)]
    odd = [page("main", f"<aside><p>{words(9)}</p></aside><div id='cookie-notice'>{words(20)}</div>") for _ in range(30)]
    schema = T.StructType().add("page_id", T.LongType()).add("url", T.StringType()).add("html", T.StringType()).add(
        "text", T.StringType()).add("n_chars", T.StringType())
    rows = [(i, "u", h, "x", "y") for i, (h, _) in enumerate(made + odd)] + [(900, None, None, "", ""), (901, "u", "", "", ""),
                                                                           (901, "u", "", "", "")]
    model = html_blocks.fit_labeller(spark.createDataFrame(rows[:120], schema))
    got = html_blocks.main_text(spark.createDataFrame(rows, schema), model, keep=("url", "text")).toPandas()
    assert len(got) == 153 and set(got["text"][got["page_id"] >= 900]) == {""}
    text = got.set_index("page_id")["text"]
    right = [text[i] == want for i, (_, want) in enumerate(made + odd)]
    assert np.mean(right[:120]) > 0.97 and np.mean(right[120:]) > 0.8
    assert (got["n_chars"] == got["text"].str.len()).all()
    nothing = spark.createDataFrame([], schema)
    assert html_blocks.fit_labeller(nothing) is None and html_blocks.main_text(nothing, None).count() == 0


def test_labeller_of_copies_and_of_long_pages(spark):
    def page(k, n):
        paragraphs = "".join(f"<p>words of the text {k} {j}</p>" for j in range(n))
        return f"<html><body><nav>menu {k}</nav><article>{paragraphs}</article><footer>end {k}</footer></body></html>"

    def fitted(pages, **options):
        frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
        return html_blocks.fit_labeller(frame, copies=1, **options)

    def same(one, other):
        return all(np.array_equal(one.w[k], other.w[k]) for k in one.w)

    few = [page(k, 4) for k in range(3)]
    model = fitted(few, sample=4)
    assert same(model, fitted(few * 100, sample=4))  # copies are neither lost nor drawn as often as they occur
    empty = [f"<p></p><!-- {k} -->" for k in range(30)]
    assert fitted(empty + few, sample=4) is not None and fitted(empty, sample=4) is None
    assert fitted([page(k, 50) for k in range(3)], sample=4, longest=20) is not None
    assert same(model, fitted([*few, page(9, 50)], sample=4, longest=20))


def shingles(texts):
    out = set()
    for t in texts:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        out |= {" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def test_contained_items_are_those_of_all_pairs(spark, docs, empty):
    rng = random.Random(10)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for k in range(40)]
    items += [(50, None), (51, "?!"), (3, items[3][1]), (None, "null id item of some six words")]
    rows = []
    for i in range(150):
        w = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items)[1] or "").split()
            if part and rng.random() < 0.5:
                part[rng.randrange(len(part))] = "changed"
            w[len(w) // 2:len(w) // 2] = part
        rows.append((i, ", ".join(w).upper()))
    rows += [(500, None), (501, ""), (5, rows[9][1]), (9, rows[9][1]), (None, "Null id item, of some six words!"),
             (502, items[0][1]), (503, "w1 " * 50_000)]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit(1))
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in contamination.contained_items(docs(rows), table).collect()}
    held = [(i, shingles([t])) for i, t in rows]
    asked = {i: shingles([t for j, t in items if j == i]) for i, _ in items}
    want = {}
    for d, h in held:
        for i, a in asked.items():
            if a and len(h & a) >= 0.8 * len(a):
                want[d, i] = max(want.get((d, i), (0, 0)), (len(h & a), len(a)))
    assert got == want and len(want) > 40
    assert contamination.contained_items(empty, table).count() == 0
    assert contamination.contained_items(docs(rows), table.limit(0)).count() == 0
