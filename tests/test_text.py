from pyspark.sql import functions as F

from corpuslink.functions import text as T
from corpuslink.functions.analysis import analyze
from corpuslink.functions.scoring import bm25, quantize_length
from corpuslink.functions.stemming import porter
from corpuslink.operators.scale import literal_rows


def values(spark, expr, *rows):
    df = literal_rows(spark, [(r,) for r in rows], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def terms(spark, text, name, **kw):
    df = literal_rows(spark, [(text,)], "x string").select(analyze(F.col("x"), name, **kw).alias("a"))
    return [(t["term"], t["pos"]) for t in df.collect()[0].a]


def test_white_space_includes_no_break_space(spark):
    assert values(spark, T.clean_text, "a\t\n  b ", None) == ["a b", ""]


def test_safe_title(spark):
    long = "w " * 100
    assert values(spark, T.safe_title, '$\\textbf{A}$ / "b"? ^{2}', long) == ["bfA b 2", ("w " * 100)[:150].strip()]


def test_alnum_numbers_and_keys(spark):
    assert values(spark, T.alnum_only, "Citroën C-4", None) == ["citronc4", ""]
    assert values(spark, lambda c: T.to_number(c), "12.5", "x", "", "1d", "nan") == [12.5, None, None, None, None]
    assert values(spark, T.strip_dot_zero, "2010.0", "2010", "1.05") == ["2010", "2010", "1.05"]
    assert values(spark, T.normalize_key, " ab1 ", None) == ["AB1", None]


def test_stem_and_page_names(spark):
    assert values(spark, T.stem_name, "a.txt", ".rc", "a.b.txt", "none") == ["a", ".rc", "a.b", "none"]
    assert values(spark, T.page_name, "p1.html") == ["p1"]


def test_highlight_marks_words_and_falls_back(spark):
    shown = values(spark, lambda c: T.highlight(c, F.array(F.lit("rete"))), "La Rete neurale. rete!", "altro")
    assert shown == ["... La <mark>Rete</mark> neurale. <mark>rete</mark>! ...", "altro"]


def test_highlight_fills_a_fragment_and_keeps_a_longer_word(spark):
    long = "w" * 250
    shown = values(spark, lambda c: T.highlight(c, F.array(F.lit("rete"), F.lit(long))), "rete " + "ab " * 200, long + " x")
    assert shown[0] == "... <mark>rete</mark> " + "ab " * 65 + " ..."
    assert shown[1] == f"... <mark>{long}</mark> ..."


def test_highlight_marks_what_the_analyser_finds(spark):
    english = values(spark, lambda c: T.highlight(c, F.array(F.lit("model")), analyzer="english"), "The Models' fit")
    assert english == ["... The <mark>Models</mark>' fit ..."]
    italian = values(spark, lambda c: T.highlight(c, F.array(F.lit("analis")), analyzer="italian"), "per l'analisi.")
    assert italian == ["... per <mark>l'analisi</mark>. ..."]
    far = values(spark, lambda c: T.highlight(c, F.array(F.lit("rete"))), "a" + "-" * 150 + "rete " + "x" * 300)
    assert far == ["... <mark>rete</mark>  ..."]


def test_light_italian_keeps_short_words_and_position_gaps(spark):
    assert terms(spark, "Le poesie scritte dell'autore: testo", "italian") == [
        ("poes", 1), ("scritt", 2), ("autor", 3), ("testo", 4)]


def test_english_analyser(spark):
    assert terms(spark, "The runner's hopping relational ponies", "english") == [
        ("runner", 1), ("hop", 2), ("relat", 3), ("poni", 4)]


def test_porter_on_published_examples():
    pairs = dict(caresses="caress", agreed="agre", plastered="plaster", sing="sing", sized="size",
                 happy="happi", conditional="condit", digitizer="digit", formalize="formal",
                 adoption="adopt", controll="control", rate="rate", cease="ceas", sky="sky")
    assert {w: porter(w) for w in pairs} == pairs


def test_tfidf_analyser_drops_short_and_listed_words(spark):
    assert [t for t, _ in terms(spark, "Figure 1: a model of the data in x", "tfidf_en")] == ["model"]


def test_length_codes(spark):
    df = literal_rows(spark, [(n,) for n in (10, 39, 40, 58, 61, 100)], "n int")
    assert [r[0] for r in df.select(quantize_length(F.col("n"))).collect()] == [10, 39, 40, 56, 60, 96]


def test_bm25_of_single_hits(spark):
    # ten documents of mean length 57.7, one hit: exact field, then text fields
    df = spark.range(1).select(
        bm25(F.lit(1), F.lit(1), F.lit(10), F.lit(1), F.lit(1.0), False),
        bm25(F.lit(1), F.lit(1), F.lit(10), F.lit(58), F.lit(57.7)))
    assert [round(v, 2) for v in df.first()] == [1.99, 2.02]


def test_publication_date_priority(spark):
    kinds = "array<struct<pub_type:string,date_type:string,year:string,month:string,day:string>>"
    rows = [([("ppub", None, "2001", None, None), ("epub", None, "2002", "3", "4")],),
            ([(None, "pub", "2001", None, None)],), ([("epub", None, "2001", "2", "30")],), ([],)]
    df = literal_rows(spark, [], f"d {kinds}").unionByName(
        spark.createDataFrame(rows, f"d {kinds}"))
    got = [str(r[0])[:10] for r in df.select(T.publication_date(F.col("d"))).collect()]
    assert got == ["2002-03-04", "2001-01-01", "1970-01-01", "1970-01-01"]
