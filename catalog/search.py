"""Text analysis and search."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.functions import analysis, wordlists
from corpuslink.functions.analysis import analyze
from corpuslink.functions.scoring import quantize_length
from corpuslink.functions.text import highlight
from corpuslink.operators import postings as P
from corpuslink.operators import search as S
from corpuslink.operators.scale import literal_rows, shared_folder, spread
from corpuslink.plans import search as plan
from corpuslink.sources.corpus import corpus_from_table

from .common import (STANDARD, WORDS2, idf_sql, quantized, quote, run_sql, table,
                     terms_sql)

FIELDS = {"nome": "keyword", "contenuto": "standard"}
ANY_QUERIES = [(1, "the ering"), (2, "of and that of"), (3, "les queque"), (4, "für sch und")]
ALL_QUERIES = [(1, "the of and"), (2, "les des queque"), (3, "that with")]
PHRASES = [(1, "of the"), (2, "the the"), (3, "de la"), (4, "and that")]
STRINGS = [(1, "contenuto:the ering"), (2, 'contenuto:"of the"'), (3, "nome:src3"),
           (4, "nome:SRC3"), (5, "altro:the"), (6, "contenuto-the")]
STOPS = sorted({*wordlists.ENGLISH_STOPS, *wordlists.MEDIA_STOPS, "les", "des", "que", "und", "der"})


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("nome"), F.col("text").alias("contenuto"), "lang")


def written(spark: SparkSession, d: str, name: str, write: Callable[[str], object]) -> str:
    """Folder of an index: written by the first query of a session that needs it, then read."""
    key = spark.sparkContext.applicationId, d, name
    if key not in _WRITTEN:
        path = f"{shared_folder(spark)}/catalog/{uuid.uuid4().hex}"
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _index(spark, d, name="documents", table_of=_docs, id_col="doc_id", fields=FIELDS) -> P.TermIndex:
    path = written(spark, d, name, lambda p: P.write_index(table_of(spark, d), id_col, fields, p))
    return P.read_index(spark, path, fields)


def _rows(spark, rows, schema="query_id int, query string") -> DataFrame:
    return literal_rows(spark, rows, schema)


def _ranked(hits: DataFrame, k: int = 10) -> DataFrame:
    return S.top_k(hits, k).select("query_id", "rank", "doc_id", "score")


def match_top10(spark, d):
    """Best ten documents for any of the query's words."""
    return _ranked(S.match_query(_index(spark, d), _rows(spark, ANY_QUERIES), "contenuto"))


def match_all_words(spark, d):
    return _ranked(S.match_query(_index(spark, d), _rows(spark, ALL_QUERIES), "contenuto", "and"))


def phrase(spark, d):
    return _ranked(S.phrase_query(_index(spark, d), _rows(spark, PHRASES), "contenuto"))


def term_lookup(spark, d):
    q = _rows(spark, [(1, "src1"), (2, "SRC1"), (3, "src12")])
    return _ranked(S.term_query(_index(spark, d), q, "nome"), 1000)


def wildcard(spark, d):
    docs = _docs(spark, d)
    return (S.wildcard_query(docs, "nome", "*c1*").select("doc_id", "score", F.lit("contains").alias("kind"))
            .unionByName(S.wildcard_query(docs, "nome", "src2*").select(
                "doc_id", "score", F.lit("prefix").alias("kind")))
            .unionByName(S.wildcard_query(docs, "nome", "s?c?*").select(
                "doc_id", "score", F.lit("letters").alias("kind"))))


def wildcard_terms(spark, d):
    clauses = _rows(spark, [(1, 0, 0, True, "wildcard", "contenuto", "thr*"),
                            (2, 0, 0, True, "wildcard", "nome", "*c1*"),
                            (3, 0, 0, True, "wildcard", "contenuto", "q*e*u"),
                            (4, 0, 0, True, "wildcard", "contenuto", "*"), (5, 0, 0, True, "wildcard", "contenuto", "?x*"),
                            (6, 0, 0, True, "wildcard", "contenuto", "*a*"), (7, 0, 0, True, "wildcard", "contenuto", "??"),
                            (8, 0, 0, True, "wildcard", "nome", "src?"), (9, 0, 0, True, "wildcard", "nome", "*")], CLAUSES)
    return S.hit_counts(S.bool_query(_index(spark, d), clauses))


CLAUSES = ("query_id int, group_id int, clause_id int, must boolean, kind string, field string, "
           "value string")


def boolean_mix(spark, d):
    """(phrase in text AND source), (word OR source), (word AND (a OR b)), required and optional."""
    rows = [(1, 0, 0, True, "phrase", "contenuto", "of the"), (1, 1, 0, True, "term", "nome", "src3"),
            (2, 0, 0, True, "any", "contenuto", "ering"), (2, 0, 1, True, "term", "nome", "src4"),
            (3, 0, 0, True, "all", "contenuto", "the"), (3, 1, 0, True, "any", "contenuto", "ering"),
            (3, 1, 1, True, "any", "contenuto", "that"),
            (4, 0, 0, True, "any", "contenuto", "that"), (4, 1, 0, False, "term", "nome", "src5")]
    return _ranked(S.bool_query(_index(spark, d), _rows(spark, rows, CLAUSES)), 20)


def hits_per_query(spark, d):
    return S.hit_counts(S.match_query(_index(spark, d), _rows(spark, ANY_QUERIES), "contenuto"))


def batch_search(spark, d):
    """Query strings to ranked hits with previews; unknown fields give nothing."""
    return plan.search(_rows(spark, STRINGS), _docs(spark, d), "doc_id", FIELDS, "any_field", 5,
                       index=_index(spark, d))


BOOSTED = [(1, "the of"), (2, "that src3"), (3, "les la"), (4, "src3"), (5, "of the of")]


def _titled(spark, d) -> DataFrame:
    return _docs(spark, d).withColumn("titolo", F.substring_index("contenuto", "\n", 1))


def boosted(spark, d):
    index = _index(spark, d, "titled", _titled,
                   fields={"titolo": "standard", "contenuto": "standard", "nome": "keyword"})
    hits = S.boosted_search(index, _rows(spark, BOOSTED),
                            {"titolo": 3, "contenuto": 2, "nome": 1})
    return _ranked(hits)


def _turns(spark, d) -> DataFrame:
    return table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), "role", "text")


def roles_and_text(spark, d):
    """Role as exact field and text together, over dialogue turns."""
    index = _index(spark, d, "turns", _turns, "turn_id", {"role": "keyword", "text": "standard"})
    rows = [(1, 0, 0, True, "term", "role", "user"), (1, 1, 0, True, "any", "text", "the of la")]
    return _ranked(S.bool_query(index, _rows(spark, rows, CLAUSES)), 25)


def postings_table(spark, d):
    return P.build_postings(_docs(spark, d), "doc_id", FIELDS).select(
        "field", "term", "doc_id", "tf", "dl", F.array_join("positions", ",").alias("positions"))


def vocabulary_stats(spark, d):
    return P.corpus_stats(_index(spark, d)).select(
        "field", "term", "df", "n_docs", F.round("avgdl", 6).alias("avgdl"))


def token_dump(spark, d):
    return P.token_dump(_docs(spark, d), "doc_id", FIELDS).select(
        "doc_id", F.array_join("nome_tokens", " ").alias("nome_tokens"),
        F.array_join("contenuto_tokens", " ").alias("contenuto_tokens"))


def _analyzed(c, name, stops=None):
    return F.array_join(F.transform(analyze(c, name, stops), lambda t: F.concat_ws(
        ":", t["pos"].cast("string"), t["term"])), " ")


def analyzers(spark, d):
    """Every analyser without stemming, as `pos:term` lists."""
    text = F.col("contenuto")
    return _docs(spark, d).select(
        "doc_id", _analyzed(text, "standard").alias("standard"),
        _analyzed(F.col("nome"), "keyword").alias("keyword"),
        _analyzed(F.concat("nome", F.lit("_"), "lang", F.lit(".txt")), "filename").alias("filename"),
        _analyzed(text, "whitespace_it", STOPS).alias("whitespace_it"),
        _analyzed(text, "standard_it", STOPS).alias("standard_it"),
        _analyzed(text, "strip_punct").alias("strip_punct"),
        _analyzed(text, "tfidf_en", STOPS).alias("tfidf_en"),
        _analyzed(text, "phrase_legacy").alias("phrase_legacy"))


def stemmed(spark, d):
    """Stemming analysers over whole texts (no SQL equivalent)."""
    names = ("italian", "english")
    italian, english = [found.select(F.lit(a).alias("analyzer"), "term", "n") for a, found in
                        zip(names, P.term_totals(_docs(spark, d), "contenuto", names))]
    return italian.unionByName(english)


def italian_terms(spark, d):
    """Occurrences of light Italian stems over whole texts, with a stop list of its own."""
    return P.term_totals(_docs(spark, d), "contenuto", [("italian", STOPS)])[0]


def length_codes(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", quantize_length(F.col("n_chars")).cast("bigint").alias("code"))


def _strings(spark, d) -> DataFrame:
    return run_sql(spark, d, STRINGS_SQL)


STRINGS_SQL = """select doc_id as query_id, case doc_id % 8
 when 0 then 'nome:' || source || '.txt' when 1 then 'contenuto:"' || replace(split_part(text, chr(10), 1), '"', '') || '"'
 when 2 then 'contenuto: ' || split_part(text, chr(10), 1) when 3 then 'testo ' || lang
 when 4 then 'altro:' || lang when 5 then 'nome ' || source || '.txt'
 when 6 then 'contenuto "' || lang || ' ' || source || '"' else 'nome ' || lang end as query
from documents"""


def query_kinds(spark, d):
    """The same strings read under each of the four query styles."""
    q = _strings(spark, d)
    out = None
    for style in ("prefix", "any_field", "words", "spaces"):
        part = S.classify_queries(q, style).withColumn("style", F.lit(style))
        out = part if out is None else out.unionByName(part)
    return out


def snippets(spark, d):
    return spread(_docs(spark, d), "doc_id").select("doc_id", highlight(
        F.col("contenuto"), F.array(F.lit("that"), F.lit("queque"))).alias("snippet"))


TOPICS = [["the", "ering"], ["les", "queque"]]


def relevant(spark, d):
    """The papers of the topics, most relevant first."""
    docs = _docs(spark, d).select("doc_id", F.substring_index("contenuto", "\n", 1).alias("title"),
                                  F.col("contenuto").alias("abstract"))
    return S.relevant_papers(docs, TOPICS, 50, id_col="doc_id")


def topic_selection(spark, d):
    docs = _docs(spark, d).select("doc_id", F.substring_index("contenuto", "\n", 1).alias("title"),
                                  F.col("contenuto").alias("abstract"), (F.col("nome") != "src7").alias("open"))
    return S.select_papers(docs, TOPICS, open_access="open").select("doc_id")


def first_documents(spark, d):
    """Head of a table as a corpus."""
    docs = table(spark, d, "documents")
    return corpus_from_table(docs.withColumn("name", F.concat("source", F.lit("/"), "doc_id")),
                             "name", "text", ["doc_id"], 100)


# -- SQL -------------------------------------------------------------------

TOK = terms_sql()


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(quote(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _words(rows) -> str:
    return _values([(q, w) for q, text in rows for w in text.split()])


def _rank(hits: str, k: int = 10) -> str:
    return (f"select query_id, rank::int as rank, doc_id, score from (select query_id, doc_id, score, row_number() over "
            f"(partition by query_id order by score desc, doc_id) as rank from "
            f"(select query_id, doc_id, round(score,4) as score from ({hits}))) where rank<={k}")


def _match_sql(rows, all_words: bool) -> str:
    having = "having count(*)=any_value(nw)" if all_words else ""
    return f"""select query_id, doc_id, sum(score*qtf) as score from tok_sc join
 (select *, count(*) over (partition by query_id) as nw from (select query_id, term, count(*) as qtf
  from (values {_words(rows)}) v(query_id, term) group by all)) using(term) group by query_id, doc_id {having}"""


def _phrase_sql(rows) -> str:
    words = _values([(q, w, i, len(t.split())) for q, t in rows for i, w in enumerate(t.split())])
    return f"""select query_id, doc_id, i*2.2*f/(f+1.2*(0.25+0.75*{quantized('dl')}/avgdl)) as score from (
 select query_id, doc_id, dl, avgdl, count(*) as f, max(i) as i from (
  select query_id, doc_id, dl, avgdl, pos-o as s, sum({idf_sql('n', 'df')}) as i from tok
  join (values {words}) v(query_id, term, o, k) using(term) join tok_df using(term) join tok_dl using(doc_id), tok_st
  group by query_id, doc_id, dl, avgdl, pos-o, k having count(*)=k) group by query_id, doc_id, dl, avgdl)"""


NOME = f"""nome_st as (select source, count(*) as df, (select count(*) from documents) as n from documents group by source),
nome_sc as (select doc_id, source, {idf_sql('n', 'df')} as score from documents join nome_st using(source))"""


def _analyzer_sql() -> str:
    stops = "[" + ", ".join(quote(s) for s in STOPS) + "]"
    not_stop = f"not list_contains({stops}, {{}})"
    punct = quote(analysis.ASCII_PUNCTUATION)
    blanks = r"'[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'"
    nonempty = "list_filter({}, lambda t: t <> '')"
    defs = {
        "standard": (f"regexp_extract_all(lower(text), {STANDARD})", "true"),
        "keyword": ("[source]", "true"),
        "filename": (nonempty.format("regexp_split_to_array(lower(source || '_' || lang || '.txt'), '[^A-Za-z0-9]+')"), "true"),
        "whitespace_it": (nonempty.format(f"regexp_split_to_array(lower(text), {blanks})"), not_stop),
        "standard_it": (f"regexp_extract_all(lower(text), {STANDARD})", not_stop),
        "strip_punct": (nonempty.format(f"regexp_split_to_array(translate(lower(text), {punct}, ''), {blanks})"), "true"),
        "tfidf_en": (f"regexp_extract_all(lower(text), {WORDS2})", not_stop),
        "phrase_legacy": (nonempty.format(
            rf"regexp_split_to_array(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\s]', '', 'g'), {blanks})"), "true")}
    cols = ", ".join(
        f"(select coalesce(string_agg((p-1) || ':' || l[p], ' ' order by p),'') from (select l, unnest(range(1, len(l)+1)) as p "
        f"from (select {tokens} as l)) where {keep.format('l[p]')}) as {name}" for name, (tokens, keep) in defs.items())
    return f"select doc_id, {cols} from documents"


def _italian_sql() -> str:
    stops = ", ".join(map(quote, STOPS))
    articles = "|".join(wordlists.ITALIAN_ELISIONS)
    plain = "translate(w, 'àáâäòóôöèéêëùúûüìíîï', 'aaaaooooeeeeuuuuiiii')"
    return f"""with t as (select unnest(regexp_extract_all(lower(text), {STANDARD})) as t from documents),
 e as (select regexp_replace(t, '^(?:{articles})[''’]', '') as w from t)
 select case when length(w)<6 then w else regexp_replace({plain}, '([ih]?[ei]|i?[ao])$', '') end as term, count(*) as n
 from e where w <> '' and w not in ({stops}) group by 1"""


def _kinds_sql() -> str:
    sp = r"[\s\x0b\x{85}\p{Z}]+"
    trim = lambda c: f"regexp_replace({c}, '^{sp}|{sp}$', '', 'g')"
    quoted = "(starts_with(a, '\"') and ends_with(a, '\"'))"
    q = f"""q as (select *, {trim("case when c>0 then substring(query, 1, c-1) else query end")} as b,
 {trim("substring(query, c+1)")} as a from (select query_id, query, position(':' in query) as c from
  (select query_id, {trim('query')} as query from ({STRINGS_SQL}))))"""
    phrase = f"case when f<>'nome' and {quoted} then 'phrase' when f='nome' then 'term' else 'any' end"
    end = "case when f is null then null else {} end"
    value1 = f"case when f<>'nome' and {quoted} then trim(a, '\"') else a end"
    value2 = f"case when f<>'nome' and {quoted} then substring(a, 2, length(a)-2) else a end"
    rest = trim("substring(query, length(w)+2)")
    return f"""with {q},
 r1 as (select *, case when starts_with(query,'nome:') then 'nome' when starts_with(query,'contenuto:') then 'contenuto' end as f from q),
 r2 as (select *, case when c>0 then b end as f from q),
 r3 as (select *, replace({rest}, '"', '') as v from (select *, split_part(query, ' ', 1) as w from q)),
 r4 as (select *, {trim("translate(a, '\"''', '')")} as v from q)
select query_id, f as field, {end.format(phrase)} as kind, {end.format(value1)} as value,
 case when f is null then 'syntax' end as error, 'prefix' as style from r1
union all select query_id, f, {end.format(phrase)}, {end.format(value2)}, case when f is null then 'syntax' end, 'any_field' from r2
union all select query_id, case when w='nome' and query<>w then 'nome.raw' when w='contenuto' and query<>w then w end,
 case when query=w or w not in ('nome','contenuto') then null when w='nome' and ends_with(v,'.txt') then 'term'
  when w='nome' then 'wildcard' when contains(query,'"') then 'phrase' else 'any' end,
 case when query=w or w not in ('nome','contenuto') then null when w='nome' and not ends_with(v,'.txt') then '*' || v || '*' else v end,
 case when query=w or w not in ('nome','contenuto') then 'syntax' end, 'words' from r3
union all select query_id, case when c>0 then b end,
 case when c=0 then null when contains(v,' ') then 'phrase' else 'any' end, case when c>0 then v end,
 case when c=0 then 'syntax' end, 'spaces' from r4"""


def snippet_sql(source: str, keys: str, terms: str, fallback: int = 300) -> str:
    """Fragments of (keys, text, terms) rows of a table expression; `terms` is a list column."""
    hit, pieces = f"list_contains({terms}, lower({{}}))", quote(STANDARD_PIECES)
    return rf"""(with a as (select *, regexp_extract_all(text, {pieces}) as p from {source}),
b as (select *, coalesce(list_position([{hit.format('x')} for x in p], true),0) as i from a),
c as (select *, case when length(array_to_string(p[greatest(i-10,1):i-1], '')) > 100 then i else greatest(i-10,1) end as st from b),
e as (select *, p[st:st+199] as w from c),
f as (select *, greatest(1, len(list_filter(range(1, len(w)+1), lambda n: length(array_to_string(w[1:n], '')) <= 200))) as n from e)
select {keys}, case when i>0 then '... ' || array_to_string([case when {hit.format('x')} then '<mark>' || x || '</mark>' else x end for x in w[1:n]], '') || ' ...'
 else replace(substring(text,1,{fallback}), chr(10), ' ') || case when length(text)>{fallback} then '...' else '' end end as snippet from f)"""


STANDARD_PIECES = analysis.STANDARD + r"|[^\p{L}\p{N}]+"


def _snippet_sql() -> str:
    return "select * from " + snippet_sql("documents", "doc_id", "['that','queque']")


def field_scores_sql(fields: list[tuple[str, float, list[tuple[int, str]]]], keys: str = "doc_id") -> str:
    """Best field of each document; a field counts if it holds all of its own query terms.

    `fields`: score table, boost and the (query, term) rows that its analyser keeps.
    """
    parts = []
    for table_, boost, rows in fields:
        terms = _values(rows)
        parts.append(f"""select query_id, {keys}, {boost} * sum(score * qtf) as s from {table_} join (select query_id, term, count(*) as qtf,
 count(*) over (partition by query_id) as n_terms from (values {terms}) v(query_id, term) group by query_id, term) w using (term)
 group by query_id, {keys}, n_terms having count(*) = n_terms""")
    return f"select query_id, {keys}, max(s) as score from ({' union all '.join(parts)}) group by query_id, {keys}"


def _boosted_sql() -> str:
    words = [(q, w) for q, text in BOOSTED for w in text.split()]
    fields = [("tok_sc", 2, words), ("tt_sc", 3, words), ("nome_t", 1, list(BOOSTED))]
    return f"""with ttl as (select doc_id, split_part(text, chr(10), 1) as title from documents), {TOK},
{terms_sql('ttl', 'doc_id', 'title', 'tt')}, {NOME}, nome_t as (select *, source as term from nome_sc)
{_rank(field_scores_sql(fields))}"""


def _relevant_sql() -> str:
    words = [(k, w) for k, g in enumerate(TOPICS) for w in g]
    return f"""with ttl as (select doc_id, split_part(text, chr(10), 1) as title from documents), {TOK},
{terms_sql('ttl', 'doc_id', 'title', 'tt')}, r as (select doc_id, round(sum(score), 4) as score from (
 {field_scores_sql([('tok_sc', 2, words), ('tt_sc', 3, words)])}) group by doc_id)
select row_number() over (order by score desc, doc_id)::int as rank, doc_id, score from r qualify rank <= 50"""


def _bool_sql() -> str:
    c3 = "select doc_id, sum(score) as score from tok_sc where term={} group by doc_id"
    return f"""with {TOK}, {NOME}, ph as ({_phrase_sql([(1, 'of the')])}),
h as (select 1 as query_id, 0 as g, doc_id, score from ph
 union all select 1, 1, doc_id, score from nome_sc where source='src3'
 union all select 2, 0, doc_id, score from ({c3.format("'ering'")})
 union all select 2, 0, doc_id, score from nome_sc where source='src4'
 union all select 3, 0, doc_id, score from ({c3.format("'the'")})
 union all select 3, 1, doc_id, score from ({c3.format("'ering'")})
 union all select 3, 1, doc_id, score from ({c3.format("'that'")})
 union all select 4, 0, doc_id, score from ({c3.format("'that'")})
 union all select 4, 1, doc_id, score from nome_sc where source='src5'),
s as (select query_id, doc_id, sum(score) as score, count(distinct case when query_id<>4 or g=0 then g end) as met
 from h group by all)
{_rank("select query_id, doc_id, score from s where met = case when query_id in (1,3) then 2 else 1 end", 20)}"""


def _batch_sql() -> str:
    hits = f"""select query_id, doc_id, score from ({_match_sql([(1, 'the ering')], False)})
 union all select query_id, doc_id, score from ({_phrase_sql([(2, 'of the')])})
 union all select 3, doc_id, score from nome_sc where source='src3'"""
    return f"""with {TOK}, {NOME} select r.query_id, r.rank, r.doc_id, d.source as name, r.score,
 replace(substring(d.text,1,50), chr(10), ' ') || '...' as preview
from ({_rank(hits, 5)}) r join documents d using(doc_id)"""


ROLE = f"""select 1 as query_id, t.doc_id, t.score + r.score as score from
 (select doc_id, sum(score) as score from tok_sc where term in ('the','of','la') group by doc_id) t join
 (select conv_id*1000+turn as doc_id, {idf_sql("(select count(*) from conversations)", "(select count(*) from conversations where role='user')")} as score
  from conversations where role='user') r using(doc_id)"""

QUERIES = {
    "search_match_any_top10": match_top10, "search_match_all": match_all_words, "search_phrase": phrase,
    "search_term_exact": term_lookup, "search_wildcard": wildcard, "search_wildcard_terms": wildcard_terms,
    "search_boolean": boolean_mix, "search_hit_counts": hits_per_query, "search_batch": batch_search,
    "search_boosted_fields": boosted, "search_relevant_papers": relevant, "search_conversations": roles_and_text,
    "index_postings": postings_table, "index_corpus_stats": vocabulary_stats, "index_token_dump": token_dump,
    "index_first_documents": first_documents, "analyzers_unstemmed": analyzers, "analyzers_stemmed": stemmed,
    "analyzers_italian": italian_terms,
    "scoring_length_codes": length_codes, "search_query_kinds": query_kinds, "search_snippets": snippets,
    "search_topic_selection": topic_selection}

ORACLE = {
    "search_match_any_top10": f"with {TOK} {_rank(_match_sql(ANY_QUERIES, False))}",
    "search_match_all": f"with {TOK} {_rank(_match_sql(ALL_QUERIES, True))}",
    "search_phrase": f"with {TOK} {_rank(_phrase_sql(PHRASES))}",
    "search_term_exact": f"""with {NOME} {_rank('''select 1 as query_id, doc_id, score from nome_sc where source='src1'
 union all select 3, doc_id, score from nome_sc where source='src12' ''', 1000)}""",
    "search_wildcard": """select doc_id, 1.0::double as score, 'contains' as kind from documents where contains(source,'c1')
 union all select doc_id, 1.0::double, 'prefix' from documents where starts_with(source,'src2')
 union all select doc_id, 1.0::double, 'letters' from documents where source like 's_c_%'""",
    "search_wildcard_terms": f"""with {TOK} select * from (select 1 as query_id, count(distinct doc_id) as n_hits from tok where starts_with(term,'thr')
 union all select 2, count(*) from documents where contains(source,'c1')
 union all select 3, count(distinct doc_id) from tok where regexp_full_match(term,'q.*e.*u')
 union all select 4, count(distinct doc_id) from tok union all select 5, count(distinct doc_id) from tok where term like '_x%'
 union all select 6, count(distinct doc_id) from tok where contains(term,'a') union all select 7, count(distinct doc_id) from tok where length(term)=2
 union all select 8, count(*) from documents where source like 'src_' union all select 9, count(source) from documents) where n_hits>0""",
    "search_boolean": _bool_sql(),
    "search_hit_counts": f"with {TOK} select query_id, count(*) as n_hits from ({_match_sql(ANY_QUERIES, False)}) group by query_id",
    "search_batch": _batch_sql(), "search_boosted_fields": _boosted_sql(), "search_relevant_papers": _relevant_sql(),
    "search_conversations": f"with {terms_sql('conversations', 'conv_id*1000+turn', 'text')} {_rank(ROLE, 25)}",
    "index_postings": """with TOKEN select 'contenuto' as field, term, doc_id, tf, dl::int as dl, positions from
 (select term, doc_id, count(*) as tf, string_agg(pos, ',' order by pos) as positions from tok group by all) join tok_dl using(doc_id)
 union all select 'nome', source, doc_id, 1, 1, '0' from documents""".replace("TOKEN", TOK),
    "index_corpus_stats": f"""with {TOK} select 'contenuto' as field, term, df, n as n_docs, round(avgdl,6) as avgdl from tok_df, tok_st
 union all select 'nome', source, count(*), (select count(*) from documents), 1.0 from documents group by source""",
    "index_token_dump": f"""select doc_id, source as nome_tokens,
 array_to_string(regexp_extract_all(lower(text), {STANDARD}), ' ') as contenuto_tokens from documents""",
    "index_first_documents": "select source || '/' || doc_id as nome, text as contenuto from documents order by doc_id limit 100",
    "analyzers_unstemmed": _analyzer_sql(),
    "analyzers_italian": _italian_sql(),
    "scoring_length_codes": f"select doc_id, {quantized('n_chars')} as code from documents",
    "search_query_kinds": _kinds_sql(), "search_snippets": _snippet_sql(),
    "search_topic_selection": f"""with a as (select doc_id, source, regexp_extract_all(lower(split_part(text, chr(10), 1)), {STANDARD}) as t,
 regexp_extract_all(lower(text), {STANDARD}) as x from documents)
select doc_id from a where source<>'src7' and (list_has_all(t,['the','ering']) or list_has_all(x,['the','ering'])
 or list_has_all(t,['les','queque']) or list_has_all(x,['les','queque']))"""}
