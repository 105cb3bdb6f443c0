import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from corpuslink.operators import postings as P
from corpuslink.operators import search as S
from corpuslink.operators.scale import literal_rows
from corpuslink.plans import search as plan_search
from corpuslink.plans.search import search

DOCS = [(1, "reti.txt", "Le reti neurali imparano dai dati."),
        (2, "dati.txt", "Una pipeline di dati raccoglie dati grezzi e li trasforma."),
        (3, "motore.txt", "Il motore di ricerca ordina i documenti; l'analisi del testo conta."),
        (4, "indice.txt", "Indicizzare documenti rende veloce la ricerca.")]
FIELDS = {"nome": "keyword", "contenuto": "italian"}


@pytest.fixture(scope="module")
def docs(spark):
    return literal_rows(spark, DOCS, "doc_id int, nome string, contenuto string")


@pytest.fixture(scope="module")
def index(docs):
    return P.build_index(docs, "doc_id", FIELDS)


def ask(spark, docs, *strings, style="prefix", fields=FIELDS, **kw):
    q = literal_rows(spark, list(enumerate(strings)), "query_id int, query string")
    rows = search(q, docs, "doc_id", fields, style, **kw).collect()
    return {i: [r.name for r in sorted(rows, key=lambda r: r.rank) if r.query_id == i] for i in range(len(strings))}


def test_query_strings(spark, docs):
    got = ask(spark, docs, "nome:dati.txt", "nome:DATI.txt", "contenuto:documento", 'contenuto:"pipeline di dati"',
              'contenuto:"pipeline dati"', "contenuto:DATI", "altro:dati", "contenuto-dati", "contenuto:analisi")
    assert got[0] == ["dati.txt"] and got[1] == []
    assert sorted(got[2]) == ["indice.txt", "motore.txt"]      # singular finds plural
    assert got[3] == ["dati.txt"] and got[4] == []             # the gap of a stop word counts
    assert got[5][0] == "dati.txt" and len(got[5]) == 2
    assert got[6] == [] and got[7] == [] and got[8] == ["motore.txt"]


def test_unknown_field_has_no_hits_and_no_error(spark, docs):
    assert ask(spark, docs, "altro:dati", style="any_field")[0] == []


def test_words_style_uses_substrings_of_names(spark, docs):
    both = docs.withColumn("nome.raw", F.col("nome"))
    renamed = both.toDF("doc_id", "nome", "contenuto", "raw").withColumnRenamed("raw", "nome_raw")
    q = S.classify_queries(literal_rows(spark, [(0, "nome ind"), (1, "nome reti.txt"), (2, 'contenuto "di dati"')],
                                        "query_id int, query string"), "words")
    assert [(r.field, r.kind, r.value) for r in q.orderBy("query_id").collect()] == [
        ("nome.raw", "wildcard", "*ind*"), ("nome.raw", "term", "reti.txt"), ("contenuto", "phrase", "di dati")]
    assert [r.nome for r in S.wildcard_query(renamed, "nome_raw", "*ind*").collect()] == ["indice.txt"]


def test_boolean_groups(spark, index):
    schema = "query_id int, group_id int, clause_id int, must boolean, kind string, field string, value string"
    rows = [(1, 0, 0, True, "any", "contenuto", "documenti"), (1, 1, 0, True, "any", "contenuto", "motore"),
            (1, 1, 1, True, "term", "nome", "indice.txt"),
            (2, 0, 0, True, "wildcard", "nome", "*dic*"), (3, 0, 0, True, "all", "contenuto", "ricerca veloce")]
    hits = S.bool_query(index, literal_rows(spark, rows, schema)).collect()
    assert {(h.query_id, h.doc_id) for h in hits} == {(1, 3), (1, 4), (2, 4), (3, 4)}
    assert [h.score for h in hits if h.query_id == 2] == [1.0]


def test_long_query_tables_join_by_shuffle(spark, index, monkeypatch):
    q = literal_rows(spark, [(1, "dati documenti"), (2, "ricerca")], "query_id int, query string")
    rows = lambda: sorted((r.query_id, r.doc_id, round(r.score, 6))
                          for r in S.match_query(index, q, "contenuto").collect())
    expected = rows()
    monkeypatch.setattr("corpuslink.operators.search.localize", lambda df: (df, None))
    assert rows() == expected != []


def test_written_index_gives_the_same_hits(spark, docs, index, tmp_path):
    index.write(str(tmp_path / "ix"))
    again = P.read_index(spark, str(tmp_path / "ix"), FIELDS)
    once = P.write_index(docs, "doc_id", FIELDS, str(tmp_path / "once"))
    assert sorted(map(tuple, once.stats.collect())) == sorted(map(tuple, index.stats.select(once.stats.columns).collect()))
    q = literal_rows(spark, [(1, "dati ricerca")], "query_id int, query string")
    key = lambda ix: sorted((r.doc_id, round(r.score, 9)) for r in S.match_query(ix, q, "contenuto").collect())
    assert key(again) == key(once) == key(index) != []


def test_boosted_needs_all_terms_in_one_field(spark, docs):
    ix = P.build_index(docs, "doc_id", {"nome": "keyword", "contenuto": "standard"})
    q = literal_rows(spark, [(1, "dati reti"), (2, "reti.txt"), (3, "dati assente"), (4, "dati reti.txt")],
                     "query_id int, query string")
    hits = S.boosted_search(ix, q, {"nome": 3, "contenuto": 1}).collect()
    assert {(h.query_id, h.doc_id) for h in hits} == {(1, 1), (2, 1)}
    either = S.boosted_search(ix, q, {"nome": 3, "contenuto": 1}, "or").collect()
    assert {(h.query_id, h.doc_id) for h in either} == {(1, 1), (1, 2), (2, 1), (3, 1), (3, 2), (4, 1), (4, 2)}


def test_boosted_leaves_stop_words_to_each_field(spark):
    rows = [(1, "a1", "Models of speech"), (2, "a2", "The weather")]
    docs = literal_rows(spark, rows, "doc_id int, code string, body string")
    ix = P.build_index(docs, "doc_id", {"code": "keyword", "body": "english"})
    q = literal_rows(spark, [(1, "the models"), (2, "a2"), (3, "the")], "query_id int, query string")
    hits = S.boosted_search(ix, q, {"code": 1, "body": 2}).collect()
    assert {(h.query_id, h.doc_id) for h in hits} == {(1, 1), (2, 2)}


@pytest.mark.parametrize("pattern,names", [
    ("*", 4), ("**", 4), ("????.txt", 2), ("?ot*", 1), ("*i*.txt", 3), ("da[t]i*", 0), ("dati.txt", 1), ("?", 0)])
def test_wildcards_mean_the_same_in_rows_and_terms(spark, docs, index, pattern, names):
    schema = "query_id int, group_id int, clause_id int, must boolean, kind string, field string, value string"
    clause = literal_rows(spark, [(1, 0, 0, True, "wildcard", "nome", pattern)], schema)
    rows = {r.doc_id for r in S.wildcard_query(docs, "nome", pattern).collect()}
    assert {h.doc_id for h in S.bool_query(index, clause).collect()} == rows and len(rows) == names


def test_top_k_is_limited_before_the_shuffle(spark, index):
    q = literal_rows(spark, [(1, "dati")], "query_id int, query string")
    plan = S.top_k(S.match_query(index, q, "contenuto"), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_phrases_and_patterns_of_a_written_index_equal_brute_force(spark, tmp_path):
    """Overlapping phrases and patterns over few words; the dictionary is read by gram, not made again."""
    rnd, words = random.Random(3), ["aa", "ab", "aba", "b", "a.b"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    docs = literal_rows(spark, list(enumerate(texts)), "doc_id int, t string")
    made = P.build_index(docs, "doc_id", {"t": "whitespace_it"})
    ix = P.write_index(docs, "doc_id", {"t": "whitespace_it"}, str(tmp_path / "ix"))
    phrases = ["aa aa", "aa aa aa", "ab b aa", "aba", "aa missing"]
    q = literal_rows(spark, list(enumerate(phrases)), "query_id int, query string")
    want = {(i, d) for i, p in enumerate(phrases) for d, t in enumerate(texts) if f" {p} " in f" {t} "}
    for index in (made, ix):
        assert {(r.query_id, r.doc_id) for r in S.phrase_query(index, q, "t").collect()} == want
    patterns = ["a*", "*b*", "?", "a?b", "*", "zz*", "ab"]
    schema = "query_id int, group_id int, clause_id int, must boolean, kind string, field string, value string"
    clauses = literal_rows(spark, [(i, 0, 0, True, "wildcard", "t", p) for i, p in enumerate(patterns)], schema)
    match = lambda p, w: re.fullmatch(re.escape(p).replace(r"\*", ".*").replace(r"\?", "."), w)
    want = {(i, d) for i, p in enumerate(patterns) for d, t in enumerate(texts) if any(match(p, w) for w in t.split())}
    for index in (made, ix):
        assert {(r.query_id, r.doc_id) for r in S.bool_query(index, clauses).collect()} == want
    few = S.bool_query(ix, clauses.where("value in ('a*', 'zz*')"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "gram IN (a,zz)" in plan or "In(gram, [a,zz])" in plan


def test_corpus_indices_are_written_at_the_same_time(monkeypatch):
    met = threading.Barrier(3, timeout=20)

    def write(df, id_col, fields, path):
        met.wait()  # broken unless all three are under way
        return path

    monkeypatch.setattr(plan_search, "write_index", write)
    monkeypatch.setattr(plan_search, "_indexed", lambda corpus, kind: None)
    assert plan_search.write_corpus_index(None, "p") == {k: f"p/{k}" for k in plan_search.BOOSTS}


def test_postings_are_grouped_inside_rows_and_repeated_ids_together(spark):
    """A row is a document: its postings need no exchange; only ids that repeat, null among them, are shuffled."""
    rows = [(1, "b a b"), (2, ""), (3, None), (4, "a")]
    schema, fields = "doc_id int, t string", {"t": "standard"}
    once = P.build_postings(literal_rows(spark, rows, schema), "doc_id", fields)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    want = {("b", 1, 2, (0, 2), 3), ("a", 1, 1, (1,), 3), ("a", 4, 1, (0,), 1)}
    shown = lambda df: {(r.term, r.doc_id, r.tf, tuple(r.positions), r.dl) for r in df.collect()}
    assert shown(once) == want
    twice = literal_rows(spark, [*rows, (5, "c d"), (5, "c e"), (None, "f g"), (None, "f h")], schema)
    more = {("c", 5, 2, (0, 0), 2), ("d", 5, 1, (1,), 2), ("e", 5, 1, (1,), 2),
            ("f", None, 2, (0, 0), 2), ("g", None, 1, (1,), 2), ("h", None, 1, (1,), 2)}
    assert shown(P.build_postings(twice, "doc_id", fields)) == want | more


def test_terms_are_made_once_of_each_different_token(spark):
    """Totals equal those of all occurrences; stemmers follow the counting."""
    docs = literal_rows(spark, [(1, "Running runs dell'acqua the running"), (2, None), (3, "le città running")],
                        "doc_id int, t string")
    names = ["english", ("italian", ("le",))]
    for spec, found in zip(names, P.term_totals(docs, "t", names)):
        want = P.occurrences(docs, "doc_id", {"t": spec}).groupBy("term").count()
        assert {tuple(r) for r in found.collect()} == {tuple(r) for r in want.collect()}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "parquet" in plan.lower()


def test_a_posting_is_one_row_however_many_patterns_match_it(spark):
    docs = literal_rows(spark, [(1, "ab ac"), (2, "b"), (3, "ab")], "doc_id int, t string")
    index = P.build_index(docs, "doc_id", {"t": "standard"})
    schema = "query_id int, group_id int, clause_id int, must boolean, kind string, field string, value string"
    many = [(i, 0, 0, True, "wildcard", "t", "a*" if i % 2 else "*b") for i in range(130)]  # more than two masks
    found = S.bool_query(index, literal_rows(spark, many, schema))
    assert {(r.query_id, r.doc_id) for r in found.collect()} == {
        (i, d) for i in range(130) for d in ((1, 3) if i % 2 else (1, 2, 3))}
    assert found.count() == 65 * 2 + 65 * 3 and "bit_or" in found._jdf.queryExecution().optimizedPlan().toString()
