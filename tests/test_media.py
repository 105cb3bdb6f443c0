import random

from pyspark.sql import functions as F

from corpuslink.functions.markup import article_parts
from corpuslink.operators import media as M
from corpuslink.operators import papers as PP
from corpuslink.operators.scale import literal_rows
from corpuslink.operators.tfidf import cosine_pairs
from corpuslink.plans import corpus as C
from corpuslink.plans.search import corpus_search, read_corpus_index, write_corpus_index

LONG = "Speech synthesis models turn written sentences into audible speech, part {}."
PAGE_A = (
    '<html><head><base href="html/9"></head><body>'
    '<figure id="F1" class="ltx_figure"><figure id="F1.sf1" class="ltx_figure"><img src="a.png">'
    '<figcaption>Speech  synthesis</figcaption></figure><figure class="ltx_figure"><figcaption>b</figcaption></figure>'
    '<figcaption>overview</figcaption></figure>'
    '<figure id="F2" class="ltx_figure"><figcaption>Plain &lt;one&gt;</figcaption></figure>'
    '<figure class="ltx_table" id="T1"><figcaption>Models</figcaption><table><tr><td>1</td><td>2</td></tr></table></figure>'
    '<figure class="ltx_table"></figure>'
    f'<p>{LONG.format(1)}<a href="#F1">1</a><a href="#F1.sf1">1a</a><p>{LONG.format(2)}<a href="x#T1">T</a></p>'
    f'<script>var x = "</p><p>{LONG.format(9)}</p>";</script><p>{"x" * 50}</p><p>{"y" * 51}</p>'
    f'<p>{LONG.format(3)}</body></html>')
PAGE_B = (
    '<figure id="f1"><h3 class="obj_head">Fig 1</h3><figcaption>Fig 1 of many</figcaption><img src="http://h/x.png"></figure>'
    '<figure id="f2"><img src="/y.png"></figure><figure id="f3"></figure><figure class="a table-b" id="f4"><img src="z"></figure>'
    '<section class="tw" id="t1"><h4 class="obj_head">Table 1</h4><div class="caption">Cap</div><table><td>a<b>c</b></td></table></section>'
    '<div class="table-wrap"></div>' f'<p>{LONG.format(1)} <a href="y#t1">see</a>')


def _pages(spark):
    return literal_rows(spark, [("arxiv", "p1", PAGE_A), ("pubmed", "PMC1", PAGE_B)],
                        "source string, paper_id string, html string")


def test_media_of_both_feeds(spark):
    rows = {(r.paper_id, r.kind, r.object_id): r for r in M.extract_media(_pages(spark)).collect()}
    assert set(rows) == {("p1", "figure", "F1.sf1"), ("p1", "figure", "unknown"), ("p1", "figure", "F2"),
                         ("p1", "table", "T1"), ("PMC1", "figure", "f1"), ("PMC1", "figure", "f2"), ("PMC1", "table", "t1")}
    sub = rows["p1", "figure", "F1.sf1"]
    assert sub.caption == "Speech synthesis overview" and sub.img_url == "https://arxiv.org/html/9a.png"
    assert len(sub.mentions) == 1 and sub.mentions[0].startswith("Speech synthesis models")
    assert [c[-3:] for c in sub.context_paragraphs] == ["2.T", " 3."]   # paragraph 1 mentions it
    assert rows["p1", "figure", "F2"].caption == "Plain <one>"
    assert rows["p1", "table", "T1"].body_content == "1 2"
    assert rows["PMC1", "figure", "f1"].caption == "Fig 1 of many"
    assert rows["PMC1", "figure", "f2"].img_url == "https://pmc.ncbi.nlm.nih.gov/y.png"
    assert rows["PMC1", "table", "t1"].caption == "Table 1 Cap" and rows["PMC1", "table", "t1"].body_content == "a c"
    assert rows["PMC1", "table", "t1"].context_paragraphs == []         # fewer than three paragraphs
    nested = M.figures_a(M.elements(_pages(spark)).where("source = 'arxiv'"), only_nested=True)
    assert {r.object_id for r in nested.collect()} == {"F1.sf1", "unknown"}


def test_paragraphs_need_more_than_fifty_characters(spark):
    rows = M.extract_paragraphs(_pages(spark)).where("source = 'arxiv'").orderBy("para_idx").collect()
    assert [r.text[:1] for r in rows] == ["S", "S", "y", "S"] and [len(r.hrefs) for r in rows] == [2, 1, 0, 0]


def test_cosine_pairs_need_three_paragraphs_and_pass_the_threshold(spark):
    paras = literal_rows(spark, [("p", i, t) for i, t in enumerate(["red fish swim deep", "fish swim", "birds fly high"])]
                         + [("q", 0, "fish swim"), ("q", 1, "fish")], "g string, i int, text string")
    objs = literal_rows(spark, [("p", 1, "fish swim"), ("q", 1, "fish"), ("p", 2, "unseen words")], "g string, o int, text string")
    rows = {(r.g, r.o, r.i): round(r.cosine, 3) for r in cosine_pairs(objs, paras, "g", "o", "i").collect()}
    assert set(rows) == {("p", 1, 0), ("p", 1, 1)} and rows["p", 1, 1] == 1.0


XML = ('<a><front><article-title>On <i>fish</i></article-title><contrib contrib-type="author"><name><surname>Rossi</surname>'
       '<given-names>M</given-names></name></contrib><contrib contrib-type="author"><name><surname>Solo</surname></name></contrib>'
       '<contrib contrib-type="author"><name/></contrib><contrib contrib-type="editor"><name><surname>E</surname></name></contrib>'
       '<pub-date pub-type="epub"><year>2020</year></pub-date><abstract><title>Aim</title><p>Text</p></abstract></front></a>')


def test_article_xml(spark):
    df = literal_rows(spark, [("7", XML), ("8", "<broken"), ("9", "<a/>")], "id string, xml string")
    rows = {r.document_id: r for r in PP.parse_article_xml(df, "xml", "id").collect()}
    assert set(rows) == {"PMC7", "PMC9"}
    assert rows["PMC7"].title == "On fish" and rows["PMC7"].authors == ["M Rossi", "Solo"]
    assert str(rows["PMC7"].date)[:10] == "2020-01-01" and rows["PMC7"].abstract == "Text"
    assert rows["PMC9"].title == "Title Unknown" and str(rows["PMC9"].date)[:10] == "1970-01-01"
    kept = PP.parse_article_xml(df, "xml", "id", keep_malformed=True)
    assert kept.where("status = 'malformed'").count() == 1
    assert df.select(article_parts(F.col("xml")).alias("x")).where("x.status = 'ok'").count() == 2


def test_corpus_build_report_and_search(spark, tmp_path):
    feed = literal_rows(spark, [("http://x/abs/p1", "Speech paper", ["A B"], None, "summary"),
                                ("http://x/abs/p1", "Speech paper again", ["A B"], None, "summary")],
                        "entry_id string, title string, authors array<string>, published timestamp, summary string")
    articles = literal_rows(spark, [("1", XML)], "article string, xml string")
    corpus = C.build_corpus(feed, articles, _pages(spark))
    counts = {(r.object, r.source): r.n for r in C.corpus_counts(corpus).collect()}
    assert counts["papers", "ALL"] == 2 and counts["figures", "arxiv"] == 3 and counts["tables", "ALL"] == 2
    report = {r.object_id: r for r in C.media_report(corpus).collect()}
    assert report["T1"].parent_found and report["T1"].n_mentions == 1
    corpus.write(str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c" / "papers")).count() == 2
    q = literal_rows(spark, [(1, "speech synthesis")], "query_id int, query string")
    found = corpus_search(q, corpus, k=5).collect()
    best = min(found, key=lambda r: r.merged_rank)
    assert best.kind == "figures" and "<mark>Speech</mark>" in best.primary_text
    assert {r.kind for r in corpus_search(q, corpus, "tables").collect()} == {"tables"}
    write_corpus_index(corpus, str(tmp_path / "ix"))
    again = corpus_search(q, corpus, k=5, index=read_corpus_index(spark, str(tmp_path / "ix"))).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def _similar(spark):
    from pyspark.sql import functions as F

    from corpuslink.operators import tfidf as W

    rnd = random.Random(5)
    words = [f"w{k}" for k in range(30)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    paras = [(g, i, text(12)) for g in (1, 2, None) for i in range(6)] + [(3, 0, text(9)), (1, 2, text(5)), (1, 5, None)]
    objs = [(g, o, text(6)) for g in (1, 2, 3, None) for o in range(3)] + [(1, 0, text(4))]
    schema = "g int, i int, text string"
    p, o = literal_rows(spark, paras, schema), literal_rows(spark, objs, schema.replace("i int", "o int"))
    weights = W.tfidf(p, "g", "i", min_texts=3)
    pairs = W.cosine_pairs(o, p, "g", "o", "i")
    return weights, pairs, F


def test_texts_of_a_paper_are_weighed_in_one_task_and_large_papers_over_their_terms(spark, monkeypatch):
    """Both ways give the same; of the usual papers only the texts are exchanged, once."""
    from corpuslink.operators import tfidf as W

    weights, pairs, F = _similar(spark)
    for df, sources in ((weights, 1), (pairs, 1)):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == sources
    shown = lambda df, c: {(*r[:-1], round(r[-1], 9)) for r in df.collect()}
    near = shown(weights, "weight"), shown(pairs, "cosine")
    assert near[0] and near[1] and {r[0] for r in near[1]} == {1, 2}
    monkeypatch.setattr(W, "LARGE_GROUP", 1)
    weights, pairs, _ = _similar(spark)
    assert (shown(weights, "weight"), shown(pairs, "cosine")) == near


def test_markup_is_read_in_small_parts(spark, monkeypatch):
    import pandas as pd

    from corpuslink.functions import markup

    monkeypatch.setattr(markup, "ROWS_AT_ONCE", 3)
    monkeypatch.setattr(markup, "CHARS_AT_ONCE", 10)
    texts = ["abc", None, "de", "f", "x" * 50, "g"]
    parts = [list(s) for s in markup._slices(pd.Series(texts))]
    assert sum(parts, []) == texts and max(map(len, parts)) == 3 and ["x" * 50] in parts
    assert [list(s) for s in markup._slices(pd.Series([], dtype=object))] == [[]]


def test_media_report_joins_previews_not_texts(spark):
    from corpuslink.plans import corpus as plan

    schema = "source string, paper_id string, {0}_id string, caption string, mentions array<string>, context_paragraphs array<string>"
    rows = [("s", "p", "x", "c" * 500, ["m" * 500], ["t" * 500]), ("s", None, "y", None, None, None)]
    media = {k: literal_rows(spark, rows, schema.format(k)) for k in ("figure", "table")}
    papers = literal_rows(spark, [("p", "T" * 100)], "document_id string, title string")
    report = plan.media_report(plan.Corpus(papers, media["figure"], media["table"]))
    plan_lines = report._jdf.queryExecution().analyzed().toString().splitlines()
    below = [plan_lines[k + 1] for k, line in enumerate(plan_lines) if "Join LeftOuter" in line]
    assert len(below) == 2 and all("caption_preview" in line for line in below)  # cut before the join
    got = {(r.object, r.object_id): r for r in report.collect()}
    assert got["figure", "x"].parent_title == "T" * 80 + "..." and got["table", "x"].caption_preview == "c" * 200 + "..."
    assert got["figure", "x"].context_preview == "t" * 150 + "..." and not got["table", "y"].parent_found
