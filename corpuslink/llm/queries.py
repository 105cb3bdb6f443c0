"""Registered queries of the operators in this package and their SQL."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.llm import (byte_bpe, collocations, contamination, html_blocks, language, line_templates, merkle, packing,
                            recompression, secrets, simhash, token_counts, topk)
from corpuslink.operators.scale import materialize

#: Files of public tokenizers; they stay where they are installed.
BYTE_BPE, WORD_BPE, MULTI_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def packed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every piece with its place; the ids themselves are left out after their checksum."""
    pieces = packing.token_pieces(docs, tokenizer_path(WORD_BPE))
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim)


def best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packed_documents(spark, table(spark, d, "documents"))


def token_count(spark: SparkSession, d: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, d, "documents"), tokenizer_path(BYTE_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def simhash_components(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    found = language.identify_languages(docs, language.fit_languages(docs))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred",
                        "score", "accepted")


def line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_templates.drop_recurring_lines(table(spark, d, "documents"))


def decontamination(spark: SparkSession, d: str) -> DataFrame:
    return contamination.contained_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


def _span_text(spans: str) -> Column:
    kinds = F.array(*map(F.lit, secrets.KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, d, "documents"))
    counts = [F.size(F.filter("base", lambda s, k=k: s["kind"] == k)).cast("bigint").alias(f"n_{name}")
              for k, name in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(_span_text("base"), 256).alias("base_sha256"),
                        _span_text("spans").alias("spans"))


def exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_products(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


def substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = recompression.drop_repeats(table(spark, d, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def html_extraction(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return html_blocks.main_text(pages, html_blocks.fit_labeller(pages))


def dataset_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Every document's proof, and what its tampered copy would fold to (a seventh has one more character)."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).alias("n_chars")
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    leaf = merkle.leaf_digest(*map(F.col, names))
    other = merkle.leaf_digest(*[more if n == "n_chars" else F.col(n) for n in names])
    rows = materialize(table(spark, d, "documents").select(
        "doc_id", "lang", leaf.alias("digest"), F.when(tampered, other).alias("tampered")))
    proven = merkle.prove(merkle.manifest(rows, F.col("lang"), "doc_id"))
    siblings = F.transform(F.filter("path", lambda s: s["side"] < 2), lambda s: F.lower(F.hex(s["digest"])))
    hexed = {n: F.lower(F.hex(c)) for n, c in (("leaf", "digest"), ("subroot", "subroot"), ("root", "root"))}
    folded = merkle.fold(F.coalesce("tampered", "digest"), F.col("path"))
    out = proven.select("doc_id", *[c.alias(n) for n, c in hexed.items()],
                        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), folded.alias("folded_root"), "reached")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def phrase_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.top_phrases(table(spark, d, "documents"))


def byte_bpe_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = tokenizer_path(MULTI_BPE)
    back = byte_bpe.decode(byte_bpe.encode(table(spark, d, "documents"), path), path)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op4_html_extraction": html_extraction,
    "op5_substring_dedup": substring_dedup,
    "op1_line_dedup": line_dedup,
    "op2_secret_scan": secret_scan,
    "op8_exact_top_k": exact_top_k,
    "op10_benchmark_decontamination": decontamination,
    "op3_simhash_near_dedup": simhash_components,
    "op6_best_fit_packing": best_fit_packing,
    "op7_language_id": language_id,
    "op9_token_counts": token_count,
    "op11_merkle_manifest": dataset_manifest,
    "op12_phrase_collocations": phrase_collocations,
    "op13_byte_bpe": byte_bpe_round_trip,
}

LINES_SQL = r"""with l as (select doc_id, length(text) as total,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos, unnest(string_split(text, chr(10))) as line
  from documents),
p as (select *, regexp_replace(trim(line, E' \t\x0b\f\r'), '[ \t\x0b\f\r]+', ' ', 'g') as plain from l),
t as (select doc_id, total, pos, length(line) as chars, string_split(case when len(string_split(plain, ' ')) < 3 then plain
    else regexp_replace(plain, '[^ ]*[0-9][^ ]*', '<*>', 'g') end, ' ') as toks from p where plain <> ''),
f as (select *, len(toks) as n, [len(toks)::varchar, toks[1], toks[2], toks[3]] as leaf from t
  qualify count(*) over (partition by leaf) >= 10),
v as (select leaf, n, p, tok, count(*) as c from (select leaf, n, unnest(toks) as tok,
    generate_subscripts(toks, 1) as p from f) group by all),
w as (select leaf, n, list(p) as fields from (select leaf, n, p from v group by all having max(c) * 2 < sum(c))
  group by all having 10 * (n - count(*)) >= 7 * n),
m as (select f.doc_id, total, pos, chars, md5(array_to_string(case when fields is null then toks else
    list_transform(toks, lambda x, i: case when list_contains(fields, i) then '<*>' else x end) end, ' ')
    || ' ' || f.n) as template from f left join w on f.leaf = w.leaf),
a as (select template from m group by template having count(distinct doc_id) >= 10),
h as (select doc_id, case when sum(chars) <= total * 0.8::double then 's' || any_value(text) else 't' || min(template) end as voice
  from m semi join a using (template) join documents using (doc_id) group by doc_id, total),
b as (select template from m semi join a using (template) join h using (doc_id) group by template
  having count(distinct voice) >= 10),
d as (select doc_id, list(pos) as gone from m semi join b using (template) group by doc_id)
select doc_id, case when gone is null then text else array_to_string(list_transform(list_filter(
    list_zip(string_split(text, chr(10)), range(len(string_split(text, chr(10))))),
    lambda x: not list_contains(gone, x[2])), lambda x: x[1]), chr(10)) end as text,
  coalesce(len(string_split(text, chr(10))), 0)::int as n_lines, coalesce(len(gone), 0)::int as n_dropped
from documents left join d using (doc_id)"""


def _words_sql(text: str) -> str:
    plain = rf"trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))"
    return f"list_filter(string_split({plain}, ' '), lambda x: x <> '')"


def _shingles_sql(source: str, ident: str) -> str:
    return f"""(select distinct {ident}, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3),
  lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] end) as s
  from (select {ident}, {_words_sql('text')} as w from {source}))"""


CONTAINED_SQL = f"""with d as {_shingles_sql('documents', 'doc_id')}, b as {_shingles_sql('benchmark', 'item_id')},
n as (select item_id, count(*) as n_item from b group by item_id)
select doc_id, item_id, count(*) as n_shared, any_value(n_item) as n_item,
  count(*) / any_value(n_item) as containment
from d join b using (s) join n using (item_id) group by doc_id, item_id
having 5 * count(*) >= 4 * any_value(n_item)"""

TOP_SQL = """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.w::double[], c.w::double[])::bigint as score
  from v q, v c where q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5"""

def _field_sql(value: str) -> str:
    return f"case when ({value}) is null then '-' else strlen(({value})::varchar) || ':' || ({value})::varchar end"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


#: CRC-32 of a decimal number, bit by bit.
_CRC_SQL = """xor(4294967295, list_reduce(flatten(list_transform(string_split(doc_id::varchar, ''),
  lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, s: case when s >= 0 then xor(a, s)
  else xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end) end, 4294967295::bigint))"""

MANIFEST_SQL = f"""with recursive l as (select doc_id, coalesce('=' || lang, '') as tree, {_leaf_sql('n_chars')} as leaf,
    case when {_CRC_SQL} % 7 = 0 and n_chars is not null then {_leaf_sql('n_chars::hugeint + 1')} end as other
  from documents),
r as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as k,
    count(*) over (partition by tree) as c from l),
a as (select tree, 0 as lev, k, leaf as h, c from r union all
  select tree, lev + 1, k // 2, sha256(string_agg(h, '' order by k)), (c + 1) // 2 from a where c > 1
  group by tree, lev, k // 2, c),
s as (select tree, h as subroot, row_number() over (order by tree) - 1 as k, count(*) over () as c from a where c = 1),
b as (select 0 as lev, k, subroot as h, c from s union all
  select lev + 1, k // 2, sha256(string_agg(h, '' order by k)), (c + 1) // 2 from b where c > 1
  group by lev, k // 2, c),
p as (select q.doc_id, q.leaf, 0 as part, v.lev, (q.k >> v.lev) & 1 as side, a.h
  from r q join (select distinct tree, lev from a where c > 1) v using (tree)
  left join a on a.tree = v.tree and a.lev = v.lev and a.k = xor(q.k >> v.lev, 1)
  union all select q.doc_id, q.leaf, 1, v.lev, (s.k >> v.lev) & 1, b.h
  from r q join s using (tree) cross join (select distinct lev from b where c > 1) v
  left join b on b.lev = v.lev and b.k = xor(s.k >> v.lev, 1)),
g as (select doc_id, leaf, list(case when h is null then 'n' when side = 1 then 'l' || h else 'r' || h end
    order by part, lev) as path, coalesce(string_agg(h, '' order by part, lev), '') as proof from p group by doc_id, leaf),
o as (select r.doc_id, r.leaf, s.subroot, (select h from b where c = 1) as root, sha256(coalesce(proof, '')) as proof_sha256,
    list_reduce(coalesce(path, []), lambda x, y: sha256(case y[1] when 'n' then x when 'l' then y[2:] || x else x || y[2:] end),
      coalesce(other, r.leaf)) as folded_root
  from r join s using (tree) left join g on g.doc_id is not distinct from r.doc_id and g.leaf = r.leaf)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, true as reached, folded_root = root as verified from o"""

PHRASES_SQL = r"""with p as (select coalesce(lang, 'und') as lang, row_number() over () as row, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) as piece from documents),
w as (select lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') as w from p),
n as (select lang, sum(len(w)) as n from w group by lang),
g as (select lang, unnest(list_transform(range(1, len(w) + 2 - s), lambda i: w[i:i + s - 1])) as w
  from w, (values (1), (2), (3)) t(s) where len(w) >= s),
f as (select lang, array_to_string(w, ' ') as phrase, w, count(*) as f from g group by lang, w having count(*) >= 10),
c as (select lang, phrase, w, f as a, unnest(range(1, len(w))) as k from f where len(w) > 1),
s as (select c.lang, c.phrase, c.w, c.k, c.a, x.f as l, y.f as r,
    1000000::hugeint * c.a * c.a // (x.f::hugeint * y.f) as score from c
  join f x on x.lang = c.lang and x.w = c.w[:c.k] join f y on y.lang = c.lang and y.w = c.w[c.k + 1:]),
o as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
h as (select lang, w[i:i + 1] as w, max(a) as longer from (select lang, w, f as a, unnest([1, 2]) as i from f where len(w) = 3)
  group by all),
k as (select o.* from o left join h on h.lang = o.lang and h.w = o.w where longer is null or 100 * longer < 50 * o.a),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from k)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from r join n using (lang) where rank <= 2000"""

ORACLE: dict[str, str] = {
    "op12_phrase_collocations": PHRASES_SQL,
    "op11_merkle_manifest": MANIFEST_SQL,
    "op8_exact_top_k": TOP_SQL,
    "op1_line_dedup": LINES_SQL,
    "op10_benchmark_decontamination": CONTAINED_SQL,
}
