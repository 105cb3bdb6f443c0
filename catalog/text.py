"""Scalar functions, counts and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslink.functions import text as T
from corpuslink.operators.profile import count_by_source, summarize
from corpuslink.operators.sampling import head, latest_papers
from corpuslink.operators.search import by_source
from corpuslink.sources.corpus import parse_id_list, valid_page
from corpuslink.sources.records import document_key

from .common import clean, run_sql, table

TITLE_SQL = """select doc_id, '$' || chr(92) || 'textbf{' || split_part(text, chr(10), 1) || '}$ / "b"? ^{2} ' || replace(text, 'e', '_') as title,
 source || case when doc_id % 3 = 0 then '.tar.gz' when doc_id % 3 = 1 then '.html' else '' end as file, text, lang from documents"""


def cleaned_texts(spark, d):
    docs = run_sql(spark, d, TITLE_SQL)
    text = F.col("text")
    return docs.select(
        "doc_id", T.clean_text(F.concat(F.lit("\t "), text, F.lit("  \n"))).alias("clean"),
        T.alnum_only(text).alias("alnum"), T.safe_title(F.col("title")).alias("safe"),
        T.preview(text, 100).alias("short"), T.preview(text, 50, True).alias("dotted"),
        T.stem_name(F.col("file")).alias("stem"), T.page_name(F.col("file")).alias("page"),
        T.blank_to_null(F.get(F.split("text", "\n"), F.lit(1))).alias("blank"))


NUMBERS_SQL = """select event_id, case event_id % 6 when 0 then cast(event_id as varchar(20)) || '.0' when 1 then cast(event_id as varchar(20)) || '.25'
 when 2 then '-' || cast(event_id as varchar(20)) when 3 then 'n/a' when 4 then cast(event_id as varchar(20)) || 'd' else '' end as price from events"""


def numbers(spark, d):
    e = run_sql(spark, d, NUMBERS_SQL)
    n = T.to_number(F.col("price"))
    return e.select("event_id", T.strip_dot_zero(F.col("price")).alias("stripped"), n.alias("number"),
                    T.positive_price(n).alias("positive"))


def addresses(spark, d):
    p = table(spark, d, "pages")
    src = F.when(F.col("page_id") % 3 == 0, F.lit("")).when(F.col("page_id") % 3 == 1, F.col("url")).otherwise("/i.png")
    base = F.when(F.col("page_id") % 2 == 0, "/html/").when(F.col("page_id") % 5 == 0, "").otherwise("html/")
    return p.select(
        "page_id", T.last_segment(F.col("url")).alias("last"),
        T.html_url(F.concat(F.col("url"), F.lit("/abs/1"))).alias("html_url"),
        T.article_url(F.col("page_id")).alias("article"), T.image_url(src, base, F.lit("arxiv")).alias("image_a"),
        T.image_url(src, base, F.lit("pubmed")).alias("image_b"))


def large_pages(spark, d):
    return valid_page(table(spark, d, "pages"), 2000).select("page_id", "url")


def titles(spark, d):
    docs = run_sql(spark, d, TITLE_SQL)
    label = F.concat("lang", F.lit(" "))
    cap = F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.substring_index("text", "\n", 1))
    ident = F.when(F.col("doc_id") % 8 == 0, F.lit("")).otherwise(F.col("file"))
    return docs.select(
        "doc_id", T.compose_caption(F.col("lang"), cap, F.lit("arxiv")).alias("caption_a"),
        T.compose_caption(F.col("lang"), F.substring_index("text", "\n", 1), F.lit("pubmed")).alias("caption_b"),
        T.result_title(F.lit("docs"), cap, F.when(F.col("doc_id") % 8 == 0, label), F.lit(None), F.lit(None)).alias("doc_title"),
        T.result_title(F.lit("figures"), F.lit(None), F.lit(None), cap, ident).alias("media_title"))


DATES_SQL = """select doc_id, 2000 + doc_id % 25 as y, 1 + doc_id % 12 as m, 1 + doc_id % 31 as d, doc_id % 5 as k from documents"""


def publication_dates(spark, d):
    x = run_sql(spark, d, DATES_SQL)
    kinds = "array<struct<pub_type:string,date_type:string,year:string,month:string,day:string>>"
    none = F.lit(None).cast("string")

    def entry(pub, typ, y, m, day):
        return F.struct(F.lit(pub).cast("string").alias("pub_type"), F.lit(typ).cast("string").alias("date_type"),
                        *[(v if v is not None else none).cast("string").alias(n) for v, n in
                          ((y, "year"), (m, "month"), (day, "day"))])

    y, m, day = F.col("y"), F.col("m"), F.col("d")
    dates = (F.when(F.col("k") == 0, F.array(entry("ppub", None, y, None, None), entry("epub", None, y + 1, m, day)))
             .when(F.col("k") == 1, F.array(entry("ppub", None, y, None, None)))
             .when(F.col("k") == 2, F.array(entry("epub", None, y, F.lit(2), day)))
             .when(F.col("k") == 3, F.array(entry("other", "x", y, m, day)))
             .otherwise(F.array(entry(None, "pub", y, m, F.lit("x")))).cast(kinds))
    return x.select("doc_id", F.date_format(T.publication_date(dates), "yyyy-MM-dd").alias("date"))


def newest(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("document_id"), F.col("ts").alias("date"))
    return latest_papers(e, 10).select("document_id")


def source_counts(spark, d):
    return count_by_source(table(spark, d, "documents"))


def one_source(spark, d):
    return by_source(table(spark, d, "documents"), "src4").select("doc_id", "lang")


def first_rows(spark, d):
    return head(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], 5)


def timing_summary(spark, d):
    e = table(spark, d, "events")
    rows = summarize(e, "value", ["event_type"]).unionByName(
        summarize(e, "value").withColumn("event_type", F.lit("ALL")))
    return rows.select("event_type", "n", *[F.round(c, 4).alias(c) for c in ("sum", "mean", "min", "max", "median")])


def id_lists(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.concat(
        F.lit('{"esearchresult": {"idlist": ["'), "doc_id", F.lit('", "'), "source", F.lit('"]}}')).alias("j"))
    return parse_id_list(docs, "j").select("doc_id", "id")


def keyed_rows(spark, d):
    return document_key(table(spark, d, "conversations"), "conv_id", "turn").select("_id", "role")


FILE_URL = "'https://arxiv.org'"
QUERIES = {
    "text_cleaning": cleaned_texts, "text_numbers": numbers, "text_addresses": addresses,
    "text_large_pages": large_pages, "text_titles": titles, "text_publication_dates": publication_dates,
    "text_newest": newest, "text_source_counts": source_counts, "text_one_source": one_source,
    "text_first_rows": first_rows, "text_timing_summary": timing_summary, "text_id_lists": id_lists,
    "text_row_keys": keyed_rows}

ORACLE = {
    "text_cleaning": f"""select doc_id, {clean("text")} as clean, regexp_replace(lower(text),'[^a-z0-9]','','g') as alnum,
 trim(substring({clean("translate(regexp_replace(replace(title,'$',''), '\\\\(text|emph|textbf|textit|math[a-z]+)', '', 'g'), '{}[]^\\_/*?:\"<>|', '')")},1,150)) as safe,
 replace(substring(text,1,100),chr(10),' ') || case when length(text)>100 then '...' else '' end as short,
 replace(substring(text,1,50),chr(10),' ') || '...' as dotted, case when contains(file,'.tar') then replace(file,'.gz','') else replace(file,'.html','') end as stem,
 replace(file,'.html','') as page, case when {clean("split_part(text,chr(10),2)")}<>'' then split_part(text,chr(10),2) end as blank from ({TITLE_SQL})""",
    "text_numbers": f"""select event_id, regexp_replace(price,'\\.0$','') as stripped, try_cast(nullif(price,'') as double) as number,
 case when try_cast(nullif(price,'') as double)>0 then try_cast(nullif(price,'') as double) end as positive from ({NUMBERS_SQL})""",
    "text_addresses": """select page_id, split_part(url,'/',-1) as last, replace(url || '/abs/1','/abs/','/html/') as html_url,
 'https://pmc.ncbi.nlm.nih.gov/articles/PMC' || page_id || '/' as article,
 case when src='' or base='' then '' else 'https://arxiv.org' || case when starts_with(base,'/') then base else '/' || base end || src end as image_a,
 case when src='' then '' when starts_with(src,'http') then src else 'https://pmc.ncbi.nlm.nih.gov' || src end as image_b
 from (select *, case page_id%3 when 0 then '' when 1 then url else '/i.png' end as src,
 case when page_id%2=0 then '/html/' when page_id%5=0 then '' else 'html/' end as base from pages)""",
    "text_large_pages": "select page_id, url from pages where strlen(html)>2000",
    "text_titles": f"""select doc_id, trim(lang || ' ' || cap) as caption_a,
 case when lang<>'' and not contains(line,lang) then lang || ' ' || line else line end as caption_b,
 case when cap<>'' then cap when doc_id%8=0 then lang || ' ' else 'Documento sconosciuto' end as doc_title,
 case when cap<>'' then replace(substring(trim(cap),1,100),chr(10),' ') || case when length(trim(cap))>100 then '...' else '' end
  when ident<>'' then 'Oggetto: ' || ident else 'Immagine senza descrizione' end as media_title
 from (select *, split_part(text,chr(10),1) as line, case when doc_id%4=0 then '' else split_part(text,chr(10),1) end as cap, case when doc_id%8=0 then '' else file end as ident from ({TITLE_SQL}))""",
    "text_publication_dates": f"""select doc_id, coalesce(strftime(case k when 0 then try_cast(printf('%04d-%02d-%02d', y+1, m, d) as date) when 1 then make_date(y,1,1)
 when 2 then try_cast(printf('%04d-02-%02d', y, d) as date) when 4 then make_date(y,m,1) end, '%Y-%m-%d'), '1970-01-01') as date from ({DATES_SQL})""",
    "text_newest": "select event_id as document_id from events order by ts desc, event_id limit 10",
    "text_source_counts": "select source, count(*) as n from documents group by source union all select 'ALL', count(*) from documents",
    "text_one_source": "select doc_id, lang from documents where source='src4'",
    "text_first_rows": "select doc_id, lang from documents order by doc_id limit 5",
    "text_timing_summary": """select coalesce(event_type,'ALL') as event_type, count(value) as n, round(sum(value),4) as sum, round(avg(value),4) as mean,
 round(min(value),4) as min, round(max(value),4) as max, round(median(value),4) as median from events group by grouping sets ((event_type),())""",
    "text_id_lists": "select doc_id, cast(doc_id as varchar) as id from documents union all select doc_id, source from documents",
    "text_row_keys": "select conv_id || '_' || turn as _id, role from conversations"}
