"""Batches of term, phrase, wildcard, boolean and boosted queries with BM25."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.analysis import analyze
from ..functions.scoring import bm25, idf
from .postings import FieldSpec, TermIndex, _spec, build_index, term_grams
from .scale import literal_rows, localize

TERM, MATCH_ANY, MATCH_ALL, PHRASE, WILDCARD = "term", "any", "all", "phrase", "wildcard"
LITERAL_TERMS = 1000
#: Terms and their bytes up to which matched terms are broadcast, and patterns that share one mask.
BROADCAST_TERMS, BROADCAST_BYTES, MASK_BITS = 200_000, 16 << 20, 62


# -- query strings ---------------------------------------------------------

def classify_queries(queries: DataFrame, style: str = "prefix") -> DataFrame:
    """(query_id, query) to (query_id, field, kind, value, error).

    Styles: `prefix` knows only nome: and contenuto:; `any_field` accepts any
    field before the first colon; `words` separates field and value by a blank
    and looks names up by substring; `spaces` calls a value with a blank a
    phrase, quoted or not.
    """
    q = F.regexp_replace(F.col("query"), r"(?U)^\s+|\s+$", "")
    trim = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    colon = F.instr(q, ":")
    before = trim(F.substring_index(q, ":", 1))
    after = trim(F.substring(q, colon + 1, F.length(q)))
    quoted = after.startswith('"') & after.endswith('"')
    if style == "prefix":
        known = q.startswith("nome:") | q.startswith("contenuto:")
        field = F.when(known, F.substring_index(q, ":", 1))
        kind = F.when(field == "nome", TERM).when(quoted, PHRASE).otherwise(MATCH_ANY)
        value = F.when((field != "nome") & quoted, F.regexp_replace(after, '^"+|"+$', ""))
        value = F.coalesce(value, after)
    elif style == "any_field":
        known = colon > 0
        field = F.when(known, before)
        kind = F.when(field == "nome", TERM).when(quoted, PHRASE).otherwise(MATCH_ANY)
        value = F.when((field != "nome") & quoted,
                       F.substring(after, F.lit(2), F.length(after) - 2))
        value = F.coalesce(value, after)
    elif style == "words":
        word = F.substring_index(q, " ", 1)
        known = q.startswith("nome ") | q.startswith("contenuto ")
        rest = F.replace(trim(F.substring(q, F.length(word) + 2, F.length(q))), F.lit('"'), F.lit(""))
        field = F.when(known & (word == "nome"), "nome.raw").when(known, word)
        kind = (F.when((word == "nome") & rest.endswith(".txt"), TERM)
                .when(word == "nome", WILDCARD)
                .when(F.contains(q, F.lit('"')), PHRASE).otherwise(MATCH_ANY))
        value = F.when(kind == WILDCARD, F.concat(F.lit("*"), rest, F.lit("*"))).otherwise(rest)
    elif style == "spaces":
        known = colon > 0
        field = F.when(known, before)
        value = trim(F.translate(after, "\"'", ""))
        kind = F.when(F.contains(value, F.lit(" ")), PHRASE).otherwise(MATCH_ANY)
    else:
        raise ValueError(f"unknown style {style!r}")
    return queries.select(
        "query_id", field.alias("field"), F.when(known, kind).alias("kind"),
        F.when(known, value).alias("value"),
        F.when(~known, "syntax").alias("error"))


# -- clauses ---------------------------------------------------------------

def single_clauses(queries: DataFrame) -> DataFrame:
    """Classified queries as one required clause each."""
    return queries.where("kind is not null").select(
        "query_id", F.lit(0).alias("group_id"), F.lit(0).alias("clause_id"),
        F.lit(True).alias("must"), "kind", "field", "value")


def clause_terms(clauses: DataFrame, fields: Mapping[str, FieldSpec]) -> DataFrame:
    """Analyse clause values with the analyser of their field.

    Clauses: (query_id, group_id, clause_id, must, kind, field, value). A field
    that is not indexed gives no terms, hence no hits and no error.
    """
    raw = F.array(F.struct(F.col("value").alias("term"), F.lit(0).alias("pos")))
    terms = F.when(F.col("kind") == TERM, raw)
    for f, s in fields.items():
        terms = terms.when(F.col("field") == f, analyze(F.col("value"), *_spec(s)))
    return (clauses.where(F.col("kind") != WILDCARD).withColumn("t", terms)
            .withColumn("n_offsets", F.size("t"))
            .withColumn("n_terms", F.size(F.array_distinct(F.transform("t", lambda x: x["term"]))))
            .withColumn("t", F.explode("t"))
            .select("query_id", "group_id", "clause_id", "kind", "field",
                    F.col("t.term").alias("term"), F.col("t.pos").alias("offset"),
                    "n_offsets", "n_terms"))


CLAUSE = ["query_id", "group_id", "clause_id"]


def _scored_postings(index: TermIndex, terms: DataFrame, rows: list | None,
                     positions: bool) -> DataFrame:
    """Postings of the queried terms with df, N, avgdl, idf and score.

    A short list of terms is pushed into the scan as a literal; a long one
    reduces the postings by a semi-join. df reads the same columns as the
    scores, so that both come from one shuffle.
    """
    if rows is not None and len({r["term"] for r in rows}) <= LITERAL_TERMS:
        found = index.postings.where(F.col("term").isin(sorted({r["term"] for r in rows}))
                                     & F.col("field").isin(sorted({r["field"] for r in rows})))
    else:
        wanted = terms.select("field", "term").distinct()
        found = index.postings.join(wanted, ["field", "term"], "left_semi")
    if positions:
        found = found.withColumn("tf", F.size("positions"))
    df = (found.groupBy("field", "term")
          .agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("tf"), F.max("dl").alias("dl"))
          .where("tf > 0 and dl > 0").select("field", "term", "df"))
    if rows is not None:
        df = F.broadcast(df)  # no more rows than queried terms
    return (found.join(df, ["field", "term"]).join(F.broadcast(index.stats), "field")
            .withColumn("idf", idf(F.col("n_docs"), F.col("df")))
            .withColumn("score", bm25(F.col("tf"), F.col("df"), F.col("n_docs"),
                                      F.col("dl"), F.col("avgdl"), F.col("norms"))))


def clause_hits(index: TermIndex, clauses: DataFrame) -> DataFrame:
    """(query_id, group_id, clause_id, doc_id, score) of every clause."""
    return _clause_hits(index, *localize(clauses))


def _clause_hits(index: TermIndex, clauses: DataFrame, known: list | None) -> DataFrame:
    terms, rows = localize(clause_terms(clauses, index.fields))
    kinds = ({TERM, MATCH_ANY, MATCH_ALL, PHRASE, WILDCARD} if known is None
             else {r["kind"] for r in known})
    scored = _scored_postings(index, terms, rows, PHRASE in kinds)
    parts = []
    if PHRASE in kinds:
        parts.append(_phrase_hits(scored, terms.where(F.col("kind") == PHRASE)))
    if WILDCARD in kinds:
        parts.append(_wildcard_hits(index, clauses.where(F.col("kind") == WILDCARD)))
    if kinds - {PHRASE, WILDCARD} or not parts:
        parts.append(_match_hits(scored, terms.where(F.col("kind") != PHRASE)))
    return reduce(DataFrame.unionByName, parts)


def _match_hits(scored: DataFrame, terms: DataFrame) -> DataFrame:
    per_term = terms.groupBy(*CLAUSE, "kind", "field", "term", "n_terms").agg(
        F.count(F.lit(1)).alias("qtf"))
    return (scored.join(per_term, ["field", "term"])
            .groupBy(*CLAUSE, "kind", "n_terms", "doc_id")
            .agg(F.sum(F.col("score") * F.col("qtf")).alias("score"),
                 F.count(F.lit(1)).alias("n_found"))
            .where((F.col("kind") != MATCH_ALL) | (F.col("n_found") == F.col("n_terms")))
            .select(*CLAUSE, "doc_id", "score"))


def _phrase_hits(scored: DataFrame, terms: DataFrame) -> DataFrame:
    """A phrase starts where every term stands at start + its own offset.

    The positions of each term, less its offset, are one array; the arrays of a document
    are intersected, the words of a phrase one after the other. A group is one document
    under one clause, and a row is a posting, never a position.
    """
    q = terms.select(*CLAUSE, "field", "term", "offset", "n_offsets")
    part = F.struct("offset", "idf", F.transform("positions", lambda p: p - F.col("offset")).alias("starts"))
    words = (scored.join(q, ["field", "term"])
             .groupBy(*CLAUSE, "doc_id", "n_offsets", "dl", "avgdl", "norms")
             .agg(F.sort_array(F.collect_list(part)).alias("parts"))
             .where(F.size("parts") == F.col("n_offsets")))
    starts = F.aggregate("parts", F.col("parts")[0]["starts"], lambda s, x: F.array_intersect(s, x["starts"]))
    tf, one = F.col("freq"), F.lit(1)
    return (words.withColumn("freq", F.size(starts)).where("freq > 0")
            .withColumn("idf", F.aggregate("parts", F.lit(0.0), lambda s, x: s + x["idf"]))
            .select(*CLAUSE, "doc_id",
                    (F.col("idf") * bm25(tf, one, one, F.col("dl"), F.col("avgdl"), F.col("norms"))
                     / idf(one, one)).alias("score")))


def wildcard_regex(pattern: Column) -> Column:
    """Whole-value pattern: `*` stands for any run of characters, `?` for one."""
    escaped = F.regexp_replace(pattern, r"([\\.\[\]{}()+^$|])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.regexp_replace(F.replace(escaped, F.lit("?"), F.lit(".")),
                                                     r"\*+", ".*"), F.lit("$"))


def _wildcard_hits(index: TermIndex, wild: DataFrame) -> DataFrame:
    """Terms matching `*` and `?` patterns; every hit scores 1.

    A pattern with a literal is looked up by up to three characters of its longest
    one, which every matching term holds; one without is compared with all terms
    of its field. Both are then verified by the same expression. A written index
    holds the dictionary of grams in order, of which a few patterns read their own
    grams only; without one, it is made from the postings. The patterns that a term
    matches are bits of a mask: a posting is one row, and a document one row, however
    many patterns match it.
    """
    plain = F.array_max(F.transform(F.split("value", r"[*?]"),
                                    lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    patterns = wild.select(*CLAUSE, "field", F.substring(plain, 1, 3).alias("gram"),
                           wildcard_regex(F.col("value")).alias("re"))
    patterns, rows = localize(patterns)
    if rows is not None:  # each clause has a bit of its own
        number = {c: k for k, c in enumerate(dict.fromkeys(tuple(r[c] for c in CLAUSE) for r in rows))}
        more = [T.StructField("word", T.IntegerType()), T.StructField("bit", T.LongType())]
        place = lambda c: (number[c] // MASK_BITS, 1 << number[c] % MASK_BITS)
        bits = F.broadcast(literal_rows(patterns.sparkSession, [(*c, *place(c)) for c in number], T.StructType(
            [patterns.schema[c] for c in CLAUSE] + more)))
        patterns = F.broadcast(literal_rows(patterns.sparkSession, [
            (*r, *place(tuple(r[c] for c in CLAUSE))) for r in rows], T.StructType(patterns.schema.fields + more)))
    if index.grams is None:
        dictionary = term_grams(index.postings.join(patterns.select("field").distinct(), "field", "left_semi")
                                .select("field", "term").distinct())
    else:
        dictionary = index.grams
        if rows is not None and len({r["gram"] for r in rows}) <= LITERAL_TERMS:
            dictionary = dictionary.where(F.col("gram").isin(sorted({r["gram"] for r in rows}))
                                          & F.col("field").isin(sorted({r["field"] for r in rows})))
    found = dictionary.join(patterns, ["field", "gram"]).where(F.regexp_like("term", F.col("re")))
    postings, one = index.postings.select("field", "term", "doc_id"), F.lit(1.0).alias("score")
    if rows is None:
        found = found.select(*CLAUSE, "field", "term")
        return postings.join(found, ["field", "term"]).select(*CLAUSE, "doc_id", one).distinct()
    masks = found.groupBy("field", "term", "word").agg(F.bit_or("bit").alias("mask"))
    n, size = masks.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
    if n <= BROADCAST_TERMS and (size or 0) <= BROADCAST_BYTES:
        masks = F.broadcast(masks)
    return (postings.join(masks, ["field", "term"]).groupBy("word", "doc_id").agg(F.bit_or("mask").alias("mask"))
            .join(bits, "word").where(F.col("mask").bitwiseAND(F.col("bit")) != 0).select(*CLAUSE, "doc_id", one))


def bool_query(index: TermIndex, clauses: DataFrame) -> DataFrame:
    """(query_id, doc_id, score): every required group needs one matching clause.

    A group is an OR of clauses; required groups are joined by AND, so nested
    conditions are written as an AND of ORs. Scores of all matching clauses add
    up. Queries without a required group need any match.
    """
    clauses, known = localize(clauses)
    hits = _clause_hits(index, clauses, known)
    if known is not None and len({r["query_id"] for r in known}) == len(known):
        return hits.select("query_id", "doc_id", "score")  # one clause each: nothing to combine
    needed = clauses.groupBy("query_id").agg(
        F.count_distinct(F.when(F.col("must"), F.col("group_id"))).alias("needed"))
    required = clauses.where("must").select(*CLAUSE, F.col("group_id").alias("required"))
    if known is not None:
        needed, required = F.broadcast(needed), F.broadcast(required)
    return (hits.join(required, CLAUSE, "left")
            .groupBy("query_id", "doc_id")
            .agg(F.sum("score").alias("score"), F.size(F.collect_set("required")).alias("met"))
            .join(needed, "query_id")
            .where(F.col("met") == F.col("needed"))
            .select("query_id", "doc_id", "score"))


# -- single-kind queries ---------------------------------------------------

def _as_clauses(queries: DataFrame, field: str, kind: str) -> DataFrame:
    return single_clauses(queries.select(
        "query_id", F.lit(field).alias("field"), F.lit(kind).alias("kind"),
        F.col("query").alias("value")))


def term_query(index: TermIndex, queries: DataFrame, field: str) -> DataFrame:
    """Exact, case-sensitive lookup of (query_id, query) in one field."""
    return bool_query(index, _as_clauses(queries, field, TERM))


def match_query(index: TermIndex, queries: DataFrame, field: str, op: str = "or") -> DataFrame:
    """Analysed lookup; `or` needs one term, `and` needs all."""
    kind = MATCH_ALL if op == "and" else MATCH_ANY
    return bool_query(index, _as_clauses(queries, field, kind))


def phrase_query(index: TermIndex, queries: DataFrame, field: str) -> DataFrame:
    """Terms at consecutive positions."""
    return bool_query(index, _as_clauses(queries, field, PHRASE))


def wildcard_query(docs: DataFrame, field: str, pattern: str) -> DataFrame:
    """Rows whose whole field matches a pattern of `*` and `?`; constant score 1."""
    c, body = F.col(field), pattern.strip("*")
    if not {"*", "?"} & set(body) and pattern == f"*{body}*":
        hit = F.contains(c, F.lit(body))
    elif not {"*", "?"} & set(body) and pattern == f"{body}*":
        hit = c.startswith(body)
    else:
        hit = F.regexp_like(c, wildcard_regex(F.lit(pattern)))
    return docs.where(hit).withColumn("score", F.lit(1.0))


# -- boosted multi-field queries -------------------------------------------

def boosted_search(index: TermIndex, queries: DataFrame, boosts: Mapping[str, float],
                   op: str = "and") -> DataFrame:
    """(query_id, doc_id, score) of (query_id, query) over several fields.

    Each field analyses the whole query in its own way. `and` needs all terms of
    a field in that field, `or` one of them; a document scores its best field,
    boost times BM25. Fields that keep no term of the query take no part.
    """
    per_field = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(float(b)).alias("boost"),
                 F.transform(analyze(F.col("query"), *_spec(index.fields[f])),
                             lambda t: t["term"]).alias("terms"))
        for f, b in boosts.items()])).alias("x")
    terms = (queries.select("query_id", per_field).select("query_id", "x.*")
             .withColumn("n_terms", F.size(F.array_distinct("terms")))
             .withColumn("term", F.explode("terms"))
             .groupBy("query_id", "field", "boost", "n_terms", "term").agg(F.count(F.lit(1)).alias("qtf")))
    terms, rows = localize(terms)
    per_doc = (_scored_postings(index, terms, rows, False).join(terms, ["field", "term"])
               .groupBy("query_id", "doc_id", "field", "boost", "n_terms")
               .agg(F.sum(F.col("score") * F.col("qtf")).alias("score"), F.count(F.lit(1)).alias("n_found")))
    if op == "and":
        per_doc = per_doc.where("n_found = n_terms")
    return per_doc.groupBy("query_id", "doc_id").agg(F.max(F.col("boost") * F.col("score")).alias("score"))


# -- ranking and counts ----------------------------------------------------

def top_k(scored: DataFrame, k: int, by: Sequence[str] = ("query_id",),
          tie: Sequence[str] = ("doc_id",), digits: int = 4) -> DataFrame:
    """Best k rows per group with rank; scores are rounded before ties are cut.

    Each task keeps its own best k before the shuffle, so a query that matches
    most documents moves few rows.
    """
    order = [F.col("score").desc(), *[F.col(t) for t in tie]]
    w = Window.partitionBy(*by).orderBy(*order)
    return (scored.withColumn("score", F.round("score", digits))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


def hit_counts(hits: DataFrame) -> DataFrame:
    """Total hits per query, independent of any limit."""
    return hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"))


def relevant_papers(papers: DataFrame, groups: Sequence[Sequence[str]], n: int = 10,
                    boosts: Mapping[str, float] | None = None, analyzer: FieldSpec = "standard",
                    id_col: str = "document_id") -> DataFrame:
    """The n most relevant papers for groups of words: (rank, document_id, score).

    A paper scores, for each group of which one field holds all words, the best
    field's boost times BM25; groups add up. Equal scores are ordered by id.
    """
    boosts = boosts or {"title": 3, "abstract": 2}
    index = build_index(papers, id_col, {f: analyzer for f in boosts})
    words = literal_rows(papers.sparkSession, [(k, " ".join(g)) for k, g in enumerate(groups)],
                         "query_id int, query string")
    found = boosted_search(index, words, boosts).groupBy("doc_id").agg(F.sum("score").alias("score"))
    best = top_k(found.withColumn("query_id", F.lit(0)), n)
    return best.select("rank", F.col("doc_id").alias(id_col), "score")


def by_source(df: DataFrame, source: str) -> DataFrame:
    return df.where(F.col("source") == source)


def select_papers(papers: DataFrame, groups: Sequence[Sequence[str]],
                  columns: Sequence[str] = ("title", "abstract"),
                  analyzer: str = "standard", open_access: str | None = None) -> DataFrame:
    """Papers with all words of one group in the title, or all in the abstract."""
    tokens = {c: F.transform(analyze(F.col(c), analyzer), lambda t: t["term"]) for c in columns}
    tests = [reduce(Column.__and__, [F.array_contains(tokens[c], w) for w in words])
             for words in groups for c in columns]
    keep = reduce(Column.__or__, tests)
    if open_access:
        keep = keep & F.col(open_access)
    return papers.where(keep)
