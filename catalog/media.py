"""Pages, figures, tables and papers.

The given pages hold no media, so pages with figures, tables and links are made
from the lines of each document: line one is the caption, the others paragraphs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.operators import media as M
from corpuslink.operators import papers as PP
from corpuslink.operators.tfidf import cosine_pairs, tfidf
from corpuslink.plans import corpus as plan
from corpuslink.plans.search import corpus_search, read_corpus_index, write_corpus_index
from corpuslink.operators.scale import literal_rows
from corpuslink.functions import wordlists
from corpuslink.functions.markup import xml_text_udf
from corpuslink.functions.text import clean_text

from .common import WORDS2, clean, quote, run_sql, table, terms_sql
from .search import written


def _esc(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _cat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _lines(spark, d) -> DataFrame:
    lines = F.split("text", "\n")
    return table(spark, d, "documents").select(
        "doc_id", "lang", "text", lines[0].alias("first"),
        F.slice(lines, F.lit(2), F.size(lines)).alias("rest"))


def pages_of(spark: SparkSession, d: str) -> DataFrame:
    """(source, paper_id, html): even documents in the first feed's markup, odd
    ones in the second's; every other paragraph is left unclosed."""
    docs = _lines(spark, d)

    def body(a: str, b: str):
        return F.array_join(F.transform("rest", lambda x, i: F.concat(
            F.lit("<p>"), _esc(x), F.when(i % 3 == 0, a).when(i % 3 == 1, b).otherwise(""),
            F.when(i % 2 == 1, "</p>").otherwise(""))), "")

    first, ident = _esc(F.col("first")), F.col("doc_id")
    a = _cat('<html><head><base href="/html/', ident, '/"></head><body><figure id="F1" class="ltx_figure">'
             '<figure id="F1.sf1" class="ltx_figure"><img src="a.png"><figcaption>', first,
             '</figcaption></figure><figcaption>main</figcaption></figure><figure class="ltx_figure" id="F2">'
             '<img src="b.png"><figcaption>', F.col("lang"), '</figcaption></figure><figure id="T1" '
             'class="ltx_table"><figcaption>', first, '</figcaption><table><tr><td>', ident,
             '</td><td>x</td></tr></table></figure>',
             body(' <a href="#F1">1</a>', ' <a href="x#T1">2</a><a href="x#T1">3</a>'), '</body></html>')
    b = _cat('<body><figure id="f1"><h4 class="obj_head">Fig ', ident % 10, '.</h4><figcaption>', first,
             '</figcaption><img src="/i/', ident, '.png"></figure><figure class="fig-table" id="x"><table><tr>'
             '<td>no</td></tr></table></figure><section class="tw xbox" id="t1"><h4 class="obj_head">Table</h4>'
             '<div class="caption">', first, '</div><table><tr><td>', ident, '</td><td>', F.col("lang"),
             '</td></tr></table></section><div class="table-wrap"><table><tr><td>z</td></tr></table></div>',
             body(' <a href="#f1">1</a>', ' <a href="y#t1">2</a><a href="y#t1">3</a>'), '</body>')
    even = F.col("doc_id") % 2 == 0
    return docs.select(F.when(even, "arxiv").otherwise("pubmed").alias("source"),
                       ident.cast("string").alias("paper_id"), F.when(even, a).otherwise(b).alias("html"))


def page_text(spark, d):
    return PP.html_to_text(table(spark, d, "pages")).select("page_id", "text")


def page_paragraphs(spark, d):
    pages = table(spark, d, "pages").select(F.lit("web").alias("source"),
                                            F.col("page_id").cast("string").alias("paper_id"), "html")
    return M.extract_paragraphs(pages).select("paper_id", "para_idx", "text", F.size("hrefs").alias("n_links"))


def objects(spark, d):
    """Figures and tables of both feeds without their paragraphs."""
    return M.media_objects(M.materialize(M.elements(pages_of(spark, d)))).select(
        "source", "paper_id", "kind", "object_id", "img_url", "local_src", "caption", "body_content")


def nested_only(spark, d):
    """Figures as the nested-only rule emits them."""
    els = M.elements(pages_of(spark, d).where("source = 'arxiv'"))
    return M.figures_a(els, only_nested=True).select("paper_id", "object_id", "caption")


def explicit_mentions(spark, d):
    els = M.materialize(M.elements(pages_of(spark, d)))
    paras = M.paragraphs(els)
    found = M.mentions(M.media_objects(els), M.paragraph_links(els, paras))
    return found.select("paper_id", "kind", "obj_node", "para_idx").distinct().groupBy(
        "paper_id", "kind", "para_idx").agg(F.count(F.lit(1)).alias("n_objects"))


def full_extraction(spark, d):
    out = M.extract_media(pages_of(spark, d))
    return out.select("source", "paper_id", "kind", "object_id", "caption",
                      F.array_join("mentions", "|").alias("mentions"),
                      F.array_join("context_paragraphs", "|").alias("context"))


def _paras(spark, d) -> DataFrame:
    """Lines longer than 50 characters as paragraphs, numbered by line."""
    return (_lines(spark, d).select("doc_id", F.posexplode("rest").alias("line", "raw"))
            .where(F.length("raw") > 50).select("doc_id", "line", clean_text(F.col("raw")).alias("text")))


def weights(spark, d):
    out = tfidf(_paras(spark, d), "doc_id", "line", min_texts=3)
    return out.select("doc_id", "line", "term", F.round("weight", 6).alias("weight"))


def similar_paragraphs(spark, d):
    caps = _lines(spark, d).select("doc_id", F.lit(0).alias("obj"), F.col("first").alias("text"))
    out = cosine_pairs(caps, _paras(spark, d), "doc_id", "obj", "line")
    return out.select("doc_id", "line", F.round("cosine", 6).alias("cosine"))


def _articles(spark, d) -> DataFrame:
    """(article, xml) from documents; every fiftieth is cut short."""
    lines, ident = _lines(spark, d), F.col("doc_id")
    given = F.when(ident % 3 == 0, "").otherwise("<given-names>G</given-names>")
    when = (F.when(ident % 4 == 0, '<pub-date pub-type="ppub"><year>2001</year></pub-date><pub-date pub-type="epub">'
                   '<year>2002</year><month>3</month><day>4</day></pub-date>')
            .when(ident % 4 == 1, '<pub-date date-type="pub"><year>2010</year><month>12</month></pub-date>')
            .when(ident % 4 == 2, '<pub-date pub-type="epub"><year>2011</year><month>2</month><day>30</day></pub-date>')
            .otherwise(""))
    xml = _cat('<set><article><front><article-title>', _esc(F.col("first")), ' <i>x</i></article-title>'
               '<contrib contrib-type="author"><name><surname>', F.col("lang"), '</surname>', given,
               '</name></contrib><contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib>', when,
               '<abstract><title>Head</title><p>', _esc(F.col("first")), '</p> <sec><title>In</title></sec></abstract>'
               '</front><body><p>', _esc(F.col("text")), '</p></body></article></set>')
    return lines.select(ident.alias("article"), F.when(ident % 50 == 0, F.substring(xml, 1, 40)).otherwise(xml).alias("xml"))


def _article_papers(spark, d) -> DataFrame:
    pages = table(spark, d, "documents").where("doc_id % 7 < 3").select(
        F.concat(F.lit("PMC"), "doc_id").alias("paper_id"), F.col("text").alias("html"))
    return PP.parse_article_xml(_articles(spark, d), "xml", "article", pages)


def xml_papers(spark, d):
    return _article_papers(spark, d).select(
        "document_id", "title", F.array_join("authors", ";").alias("authors"),
        F.date_format("date", "yyyy-MM-dd").alias("date"), "abstract", "full_text", "pdf_url",
        "local_file_saved", "local_filename")


def xml_node_text(spark, d):
    title = xml_text_udf(".//article-title", "none")
    return _articles(spark, d).select("article", clean_text(title(F.col("xml"))).alias("title"))


def _feed(spark, d) -> DataFrame:
    return _lines(spark, d).select(
        F.concat(F.lit("http://example.org/abs/"), "doc_id", F.lit("v1")).alias("entry_id"),
        F.col("first").alias("title"), F.array("lang").alias("authors"),
        F.lit("2024-01-02").cast("timestamp").alias("published"), F.col("text").alias("summary"))


def _feed_papers(spark, d) -> DataFrame:
    pages = table(spark, d, "documents").where("doc_id % 3 = 0").select(
        F.concat("doc_id", F.lit("v1")).alias("paper_id"),
        _cat("<html><head><title>t</title></head><body><p>", _esc(F.col("text")), "</p></body></html>").alias("html"))
    return PP.build_papers(_feed(spark, d), pages)


def feed_papers(spark, d):
    return _feed_papers(spark, d).select(
        "document_id", "title", "full_text", "pdf_url", "local_file_saved", "local_filename")


# -- corpora ---------------------------------------------------------------

PAPER_SQL = """select case when doc_id % 2 = 0 then 'arxiv' else 'pubmed' end as source, cast(doc_id as varchar(20)) as document_id,
 split_part(text, chr(10), 1) as title, lang as authors, text as abstract, text as full_text, 'u/' || doc_id as pdf_url from documents"""
CHILD_SQL = """select case when doc_id % 2 = 0 then 'arxiv' else 'pubmed' end as source,
 case when doc_id % 7 = 0 then 'missing' else cast(doc_id as varchar(20)) end as paper_id, '{kind}' || doc_id as object_id,
 split_part(text, chr(10), 1) as caption, lang || ' ' || source as body_content, text as mention,
 replace(text, chr(10), ' ') as context from documents"""
FIGURES, TABLES_ = CHILD_SQL.format(kind="f"), CHILD_SQL.format(kind="t")


def _corpus(spark, d) -> plan.Corpus:
    papers = run_sql(spark, d, PAPER_SQL).withColumn("authors", F.array("authors")).withColumn(
        "date", F.lit("2024-01-02").cast("timestamp")).withColumn("local_file_saved", F.lit(True))
    side = lambda sql, name: run_sql(spark, d, sql).withColumnRenamed("object_id", name).withColumn(
        "mentions", F.array("mention")).withColumn("context_paragraphs", F.array("context"))
    figures = side(FIGURES, "figure_id").withColumn("img_url", F.lit("i.png"))
    return plan.Corpus(papers, figures, side(TABLES_, "table_id"))


def corpus_counts(spark, d):
    return plan.corpus_counts(_corpus(spark, d))


def paper_report(spark, d):
    return plan.paper_report(_corpus(spark, d)).select("document_id", "n_figures", "n_tables", "abstract_preview", "text_preview")


def media_report(spark, d):
    return plan.media_report(_corpus(spark, d)).select(
        "object", "paper_id", "object_id", "parent_found", "parent_title", "n_mentions", "n_context",
        "caption_preview", "context_preview")


def orphan_media(spark, d):
    c = _corpus(spark, d)
    return PP.orphans(c.figures, c.papers).select("figure_id", "paper_id")


def union_of_feeds(spark, d):
    """Papers of both feeds in one table, all columns."""
    return PP.union_papers(_feed_papers(spark, d), _article_papers(spark, d)).withColumn(
        "authors", F.array_join("authors", ";")).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _built(spark, d) -> plan.Corpus:
    """The whole build from landed feeds and pages."""
    return plan.build_corpus(
        _feed(spark, d), _articles(spark, d).select(F.col("article").cast("string").alias("article"), "xml"),
        pages_of(spark, d))


def built_corpus(spark, d):
    """The build as counts per kind and source."""
    return plan.corpus_counts(_built(spark, d))


def built_media(spark, d):
    """The figures and tables of the build, all columns."""
    corpus, none = _built(spark, d), F.lit("")
    figures = corpus.figures.withColumnsRenamed({"figure_id": "object_id"}).withColumns(
        {"kind": F.lit("figure"), "body_content": none})
    tables = corpus.tables.withColumnsRenamed({"table_id": "object_id"}).withColumns(
        {"kind": F.lit("table"), "img_url": none, "local_src": none})
    return figures.unionByName(tables).withColumns({
        "mentions": F.array_join("mentions", "|"), "context": F.array_join("context_paragraphs", "|")}).drop(
        "context_paragraphs")


CORPUS_QUERIES = [(1, "the of"), (2, "les"), (3, "that with"), (4, "100"), (5, "t200"), (6, "de la")]
CORPUS_STOPS = ("of", "with", "la")


def search_everything(spark, d):
    """Boosted search over papers, tables and figures, merged by score."""
    q = literal_rows(spark, CORPUS_QUERIES, "query_id int, query string")
    corpus, analyzer = _corpus(spark, d), ("standard", CORPUS_STOPS)
    path = written(spark, d, "corpus", lambda p: write_corpus_index(corpus, p, analyzer))
    return corpus_search(q, corpus, "all", 10, analyzer=analyzer,
                         index=read_corpus_index(spark, path, analyzer)).select(
        "query_id", "kind", "rank", "score", "doc_id", "title", "primary_text", "secondary_text", "merged_rank")


# -- SQL -------------------------------------------------------------------

LINES = """ln as (select doc_id, lang, text, string_split(text, chr(10)) as l from documents),
pr as (select doc_id, line, raw, row_number() over (partition by doc_id order by line)-1 as idx from (
 select doc_id, unnest(range(0, len(l)-1)) as line, unnest(l[2:]) as line_text,
 line_text || case line%3 when 0 then ' 1' when 1 then ' 23' else '' end as raw from ln) where length(raw)>50),
plain as (select doc_id, line, raw from (select doc_id, unnest(range(0, len(l)-1)) as line, unnest(l[2:]) as raw from ln) where length(raw)>50)"""
STOP_LIST = "[" + ", ".join(quote(s) for s in wordlists.tfidf_stop_words()) + "]"


def _tfidf_sql(paras: str, objs: str | None = None) -> str:
    """CTEs from (doc_id, line, text) paragraphs and (doc_id, obj, text) objects."""
    tok = lambda src, unit: (f"(select doc_id, {unit}, term, count(*) as tf from (select doc_id, {unit}, "  # noqa: E731
                             f"unnest(regexp_extract_all(lower(text), {WORDS2})) as term from {src}) "
                             f"where not list_contains({STOP_LIST}, term) group by all)")
    out = f"""tp as materialized {tok(paras, 'line')}, sz as (select doc_id, count(*) as n from {paras} group by doc_id having count(*)>=3),
vc as (select doc_id, term, ln((1+n)/(1+df))+1 as idf from (select doc_id, term, count(*) as df from tp group by all) join sz using(doc_id)),
rp as (select doc_id, line, term, tf*idf as w from tp join vc using(doc_id, term)),
wp as (select doc_id, line, term, w/sqrt(sum(w*w) over (partition by doc_id, line)) as weight from rp)"""
    if objs:
        out += f""", tq as {tok(objs, 'obj')}, rq as (select doc_id, obj, term, tf*idf as w from tq join vc using(doc_id, term)),
wq as (select doc_id, obj, term, w/sqrt(sum(w*w) over (partition by doc_id, obj)) as weight from rq),
cs as (select doc_id, obj, line, sum(wq.weight*wp.weight) as cosine from wq join wp using(doc_id, term) group by all having cosine>0.15)"""
    return out


C1, FIG = clean("l[1]"), "'Fig ' || doc_id%10 || '.'"
OBJECTS = f"""ob as (select doc_id, 'arxiv' as source, 'figure' as kind, 'F1.sf1' as object_id, trim({C1} || ' main') as caption, '' as body_content,
 'https://arxiv.org/html/' || doc_id || '/a.png' as img_url, 'a.png' as local_src, 0 as obj, 0 as rem from ln where doc_id%2=0
union all select doc_id, 'arxiv', 'figure', 'F2', lang, '', 'https://arxiv.org/html/' || doc_id || '/b.png', 'b.png', 1, -1 from ln where doc_id%2=0
union all select doc_id, 'arxiv', 'table', 'T1', {C1}, doc_id || ' x', '', '', 2, 1 from ln where doc_id%2=0
union all select doc_id, 'pubmed', 'figure', 'f1', case when contains({C1}, {FIG}) then {C1} else {FIG} || ' ' || {C1} end, '',
 'https://pmc.ncbi.nlm.nih.gov/i/' || doc_id || '.png', '/i/' || doc_id || '.png', 3, 0 from ln where doc_id%2=1
union all select doc_id, 'pubmed', 'table', 't1', case when contains({C1}, 'Table') then {C1} else 'Table ' || {C1} end, doc_id || ' ' || lang, '', '', 4, 1 from ln where doc_id%2=1
union all select doc_id, 'pubmed', 'table', 'unknown', '', 'z', '', '', 5, -1 from ln where doc_id%2=1)"""


def _extraction_sql(more: str = "") -> str:
    return f"""with {LINES}, {OBJECTS}, pt as (select doc_id, idx as line, line%3 as rem, {clean('raw')} as text from pr),
qt as (select doc_id, obj, caption || case when kind='table' then ' ' || body_content else '' end as text from ob),
{_tfidf_sql('pt', 'qt')},
mn as (select ob.doc_id, obj, source, kind, line, text from ob join pt using(doc_id, rem)),
mm as (select doc_id, obj, string_agg(text, '|' order by line) as mentions from (
 select * from mn where source='pubmed' or kind='table' union all
 select doc_id, obj, source, kind, min(line), text from mn where source='arxiv' and kind='figure' group by all) group by all),
cc as (select doc_id, obj, string_agg(text, '|' order by line) as context from cs anti join mn using(doc_id, obj, line) join pt using(doc_id, line) group by all)
select source, cast(doc_id as varchar) as paper_id, kind, object_id, caption, coalesce(mentions,'') as mentions, coalesce(context,'') as context{more}
from ob left join mm using(doc_id, obj) left join cc using(doc_id, obj)"""


def _page_sql() -> tuple[str, str]:
    def entities(c: str) -> str:
        for a, b in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
            c = f"replace({c}, '{a}', '{b}')"
        return c

    def drop(c: str, *patterns: str) -> str:
        for p in patterns:
            c = f"regexp_replace({c}, '{p}', '', 'g')"
        return c

    block = ("(?s)<script[^>]*>.*?</script>", "(?s)<style[^>]*>.*?</style>", "(?s)<!--.*?-->")
    body = drop("html", *block, "(?s)<head>.*?</head>", "<[^>]*>")
    text = f"select page_id, {clean(entities(body))} as text from pages"
    paras = f"""select cast(page_id as varchar) as paper_id, (row_number() over (partition by page_id order by i)-1)::int as para_idx, {clean('raw')} as text, n_links from (
 select page_id, i, {entities(drop('inner_html', '<[^>]*>'))} as raw, len(regexp_extract_all(inner_html, '<a '))::int as n_links from (
  select page_id, unnest(range(0, len(p)-1)) as i, regexp_extract(unnest(p[2:]), '(?s)^(.*?)(</p>|</article>|</body>|$)', 1) as inner_html
  from (select page_id, string_split({drop('html', *block)}, '<p>') as p from pages))) where length(raw)>50"""
    return text, paras


def _search_sql() -> str:
    from .search import field_scores_sql, snippet_sql

    words = [(q, w) for q, t in CORPUS_QUERIES for w in t.split()]
    kept = [(q, w) for q, w in words if w not in CORPUS_STOPS]
    fields = {"docs": ("pp", "document_id", {"title": 3, "abstract": 2, "full_text": 1, "authors": 1}),
              "tables": ("tb", "object_id", {"caption": 3, "body_content": 2, "mention": 1, "context": 1}),
              "figures": ("fg", "object_id", {"caption": 3, "mention": 1, "context": 1})}
    ctes, hits = [], []
    for kind, (src, ident, boosts) in fields.items():
        parts = []
        for f, boost in boosts.items():
            plain = f == "authors"
            ctes.append(terms_sql(src, "key", f, f"{src}_{f}", () if plain else CORPUS_STOPS))
            parts.append((f"{src}_{f}_sc", boost, words if plain else kept))
        ctes.append(f"""{src}_id as (select key as doc_id, {ident} as term, ln(1+((select count(*) from {src})-df+0.5)/(df+0.5)) as score
 from {src} join (select {ident}, count(*) as df from {src} group by {ident}) using ({ident}))""")
        parts.append((f"{src}_id", 1, CORPUS_QUERIES))
        hits.append(f"select '{kind}' as kind, * from ({field_scores_sql(parts)})")
    key = lambda sql: f"(select paper_id || '_' || object_id as key, * from ({sql}))"
    title = lambda c: f"replace(substring(trim({c}),1,100),chr(10),' ') || case when length(trim({c}))>100 then '...' else '' end"
    media = lambda kind, src: f"select '{kind}', key, case when caption<>'' then {title('caption')} else 'Oggetto: ' || object_id end, caption, context from {src}"
    terms = " ".join(f"when {q} then [{', '.join(quote(w) for i, w in kept if i == q)}]::varchar[]" for q, _ in CORPUS_QUERIES)
    shown = lambda text, n: snippet_sql(f"(select query_id, kind, doc_id, {text} as text, terms from st)",
                                        "query_id, kind, doc_id", "terms", n)
    return f"""with pp as (select document_id as key, * from ({PAPER_SQL})), tb as {key(TABLES_)}, fg as {key(FIGURES)},
{', '.join(ctes)}, h as (select kind, query_id, doc_id, round(score,4) as score from ({' union all '.join(hits)})),
r as (select *, row_number() over (partition by kind, query_id order by score desc, doc_id)::int as rank from h qualify rank<=10),
tt(kind, doc_id, title, first_text, second_text) as (select 'docs', key, case when title<>'' then title else 'Documento sconosciuto' end,
 abstract, full_text from pp union all {media('tables', 'tb')} union all {media('figures', 'fg')}),
st as (select *, case query_id {terms} end as terms from r join tt using(kind, doc_id)),
p1 as (select query_id, kind, doc_id, snippet as primary_text from {shown('first_text', 300)}),
p2 as (select query_id, kind, doc_id, case when kind='docs' and not starts_with(snippet, '... ') then '' else snippet end as secondary_text
 from {shown('second_text', 300)})
select query_id, kind, rank, score, doc_id, title, primary_text, secondary_text,
 row_number() over (partition by query_id order by score desc, kind, doc_id)::int as merged_rank
from st join p1 using(query_id, kind, doc_id) join p2 using(query_id, kind, doc_id)"""


QUERIES = {
    "media_page_text": page_text, "media_page_paragraphs": page_paragraphs, "media_objects": objects,
    "media_nested_figures": nested_only, "media_mentions": explicit_mentions,
    "media_full_extraction": full_extraction, "media_tfidf_weights": weights,
    "media_similar_paragraphs": similar_paragraphs, "papers_from_xml": xml_papers,
    "papers_xml_text": xml_node_text, "papers_from_feed": feed_papers, "papers_union": union_of_feeds,
    "corpus_counts": corpus_counts, "corpus_paper_report": paper_report, "corpus_media_report": media_report,
    "corpus_orphans": orphan_media, "corpus_build": built_corpus, "corpus_build_media": built_media, "corpus_search": search_everything}

GOOD = "from (select *, split_part(text, chr(10), 1) as f from documents) where doc_id%50<>0"
XML_TITLE = clean("f || ' x'")
DATE = "case doc_id%4 when 0 then '2002-03-04' when 1 then '2010-12-01' else '1970-01-01' end"
N_DOCS = "(select count(*) from documents where {})"
FROM_XML = f"""select 'PMC' || doc_id as document_id, trim(f || ' x') as title, case when doc_id%3=0 then lang else 'G ' || lang end as authors,
 {DATE} as date, {clean("f || ' In'")} as abstract, {clean('text')} as full_text, 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || doc_id || '/' as pdf_url,
 (doc_id%7<3 and strlen(text)>4000) as local_file_saved, case when doc_id%7<3 and strlen(text)>4000 then 'PMC' || doc_id || '.html' end as local_filename {GOOD}"""
FROM_FEED = f"""select doc_id || 'v1' as document_id, split_part(text, chr(10), 1) as title,
 case when saved then {clean('text')} else text end as full_text, 'http://example.org/html/' || doc_id || 'v1' as pdf_url,
 saved as local_file_saved, case when saved then doc_id || 'v1.html' end as local_filename from (select *, doc_id%3=0 and
 strlen(replace(replace(replace(text,'&','&amp;'),'<','&lt;'),'>','&gt;')) + {len('<html><head><title>t</title></head><body><p></p></body></html>')} > 2000 as saved from documents)"""
ORACLE = {
    "media_page_text": _page_sql()[0], "media_page_paragraphs": _page_sql()[1],
    "media_objects": f"with {LINES}, {OBJECTS} select source, cast(doc_id as varchar) as paper_id, kind, object_id, img_url, local_src, caption, body_content from ob",
    "media_nested_figures": f"with {LINES}, {OBJECTS} select cast(doc_id as varchar) as paper_id, object_id, caption from ob where object_id='F1.sf1'",
    "media_mentions": f"""with {LINES}, {OBJECTS} select cast(doc_id as varchar) as paper_id, kind, idx::int as para_idx, count(*) as n_objects
 from ob join pr using(doc_id) where pr.line%3=rem group by doc_id, kind, idx""",
    "media_full_extraction": _extraction_sql(),
    "media_tfidf_weights": f"""with {LINES}, pt as (select doc_id, line, {clean('raw')} as text from plain), {_tfidf_sql('pt')}
 select doc_id, line::int as line, term, round(weight,6) as weight from wp""",
    "media_similar_paragraphs": f"""with {LINES}, pt as (select doc_id, line, {clean('raw')} as text from plain),
 qt as (select doc_id, 0 as obj, l[1] as text from ln), {_tfidf_sql('pt', 'qt')} select doc_id, line::int as line, round(cosine,6) as cosine from cs""",
    "papers_from_xml": FROM_XML,
    "papers_xml_text": f"""select doc_id as article, case when doc_id%50=0 then 'none' else {XML_TITLE} end as title
 from (select *, split_part(text, chr(10), 1) as f from documents)""",
    "papers_from_feed": FROM_FEED,
    "papers_union": f"""select 'arxiv' as source, document_id, title, lang as authors, '2024-01-02' as date, text as abstract, full_text, pdf_url, local_file_saved, local_filename
 from ({FROM_FEED}) join documents on document_id = doc_id || 'v1' union all by name select 'pubmed' as source, * from ({FROM_XML})""",
    "corpus_counts": f"""with o as (select 'papers' as object, source from ({PAPER_SQL}) union all select 'figures', source from ({FIGURES})
 union all select 'tables', source from ({TABLES_})) select object, coalesce(source,'ALL') as source, count(*) as n from o group by grouping sets ((object,source),(object))""",
    "corpus_paper_report": f"""with p as ({PAPER_SQL}), f as (select paper_id, count(*) as n from ({FIGURES}) group by 1), t as (select paper_id, count(*) as n from ({TABLES_}) group by 1)
 select document_id, coalesce(f.n,0) as n_figures, coalesce(t.n,0) as n_tables, substring(abstract,1,100) || '...' as abstract_preview,
 {clean('substring(full_text,1,200)')} || '...' as text_preview from p left join f on f.paper_id=document_id left join t on t.paper_id=document_id""",
    "corpus_media_report": f"""with p as ({PAPER_SQL}), o as (select 'figure' as object, * from ({FIGURES}) union all select 'table', * from ({TABLES_}))
 select object, paper_id, object_id, document_id is not null as parent_found, replace(substring(title,1,80),chr(10),' ') || '...' as parent_title, 1 as n_mentions, 1 as n_context,
 substring({clean('caption')},1,200) || '...' as caption_preview, substring({clean('context')},1,150) || '...' as context_preview from o left join p on document_id=paper_id""",
    "corpus_orphans": f"select object_id as figure_id, paper_id from ({FIGURES}) where paper_id='missing'",
    "corpus_build": f"""with o as (select 'papers' as object, 'arxiv' as source, count(*) as n from documents
 union all select 'papers', 'pubmed', {N_DOCS.format('doc_id%50<>0')} union all select 'figures', 'arxiv', 2*{N_DOCS.format('doc_id%2=0')}
 union all select 'figures', 'pubmed', {N_DOCS.format('doc_id%2=1')} union all select 'tables', 'arxiv', {N_DOCS.format('doc_id%2=0')}
 union all select 'tables', 'pubmed', 2*{N_DOCS.format('doc_id%2=1')}) select object, coalesce(source,'ALL') as source, sum(n)::bigint as n
 from o group by grouping sets ((object,source),(object))""",
    "corpus_build_media": _extraction_sql(", img_url, local_src, body_content"),
    "corpus_search": _search_sql()}
