"""Analysers: text to an ordered list of (term, pos).

An analyser is a way to cut text into tokens, an optional clean-up of each
token, an optional stop list (positions keep the gaps) and an optional stemmer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import stemming, wordlists

# Token patterns, the same text in every engine.
STANDARD = r"[\p{L}\p{N}]+(?:[.'’][\p{L}\p{N}]+)*"
TWO_LETTERS = r"[\p{L}\p{N}_][\p{L}\p{N}_]+"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPACES = r"(?U)[\s\x1c-\x1f]+"


@dataclass(frozen=True)
class Analyzer:
    tokens: Callable[[Column], Column]
    clean: Callable[[Column], Column] | None = None
    stops: Callable[[], Iterable[str]] | None = None
    stem: Callable[[Column], Column] | None = None
    stem_all: Callable[[Column], Column] | None = None
    norms: bool = True
    arrow: bool = False  # the stemmer runs in Python, on a column of terms

    def kept(self, term: Column) -> Column | None:
        words = list(self.stops()) if self.stops else []
        return ~term.isin(words) if words else None


def _extract(pattern: str) -> Callable[[Column], Column]:
    return lambda c: F.regexp_extract_all(F.lower(c), F.lit(pattern), F.lit(0))


def _split(pattern: str) -> Callable[[Column], Column]:
    return lambda c: F.filter(F.split(c, pattern), lambda t: t != "")


def _lower_all(c: Column) -> Column:
    return F.transform(c, F.lower)


def _elide(term: Column) -> Column:
    articles = "|".join(wordlists.ITALIAN_ELISIONS)
    return F.regexp_replace(term, f"^(?:{articles})['’]", "")


def _english_possessive(term: Column) -> Column:
    return F.regexp_replace(term, "['’]s$", "")


_standard = _extract(STANDARD)
_italian = lambda: wordlists.spark_stop_words("italian")

ANALYZERS: dict[str, Analyzer] = {
    "standard": Analyzer(_standard),
    "italian": Analyzer(_standard, _elide, _italian, stemming.italian_light,
                        lambda a: F.transform(a, stemming.italian_light)),
    "english": Analyzer(_standard, _english_possessive, lambda: wordlists.ENGLISH_STOPS,
                        lambda c: stemming.porter_stem(c),
                        lambda a: stemming.porter_stem_all(a), arrow=True),
    "keyword": Analyzer(lambda c: F.array(c), norms=False),
    "filename": Analyzer(lambda c: _lower_all(_split("[^A-Za-z0-9]+")(c))),
    "whitespace_it": Analyzer(lambda c: _lower_all(_split(SPACES)(c)), stops=_italian),
    "standard_it": Analyzer(_standard, stops=_italian),
    "strip_punct": Analyzer(lambda c: _split(SPACES)(
        F.translate(F.lower(c), ASCII_PUNCTUATION, ""))),
    "tfidf_en": Analyzer(_extract(TWO_LETTERS), stops=wordlists.tfidf_stop_words),
    "phrase_legacy": Analyzer(lambda c: _split(SPACES)(
        F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\s]", ""))),
}


def get_analyzer(name: str, stop_words: Iterable[str] | None = None) -> Analyzer:
    """Analyser by name, optionally with another stop list."""
    found = ANALYZERS[name]
    return found if stop_words is None else replace(found, stops=lambda: tuple(stop_words))


def analyze(c: Column, name: str, stop_words: Iterable[str] | None = None) -> Column:
    """Text to ARRAY<STRUCT<term, pos>>; pos counts tokens before stop words."""
    a = get_analyzer(name, stop_words)
    tokens = F.coalesce(a.tokens(c), F.array().cast("array<string>"))
    clean = a.clean or (lambda t: t)
    rows = F.transform(tokens, lambda t, i: F.struct(clean(t).alias("term"), i.alias("pos")))
    if a.clean or a.stops:
        rows = F.filter(rows, lambda r: _keeps(a, r["term"]))
    if a.stem_all:
        stems = a.stem_all(F.transform(rows, lambda r: r["term"]))
        rows = F.zip_with(stems, rows, lambda s, r: F.struct(s.alias("term"), r["pos"].alias("pos")))
    return rows


def _keeps(a: Analyzer, word: Column) -> Column:
    kept = a.kept(word)
    return (word != "") if kept is None else (word != "") & kept


def _kept_tokens(a: Analyzer, c: Column) -> Column:
    tokens = F.coalesce(a.tokens(c), F.array().cast("array<string>"))
    if a.clean or a.stops:
        clean = a.clean or (lambda t: t)
        tokens = F.filter(tokens, lambda t: _keeps(a, clean(t)))
    return tokens


def analyzed_length(c: Column, name: str, stop_words: Iterable[str] | None = None) -> Column:
    """Number of terms `analyze` yields, without stemming them."""
    length = F.size(_kept_tokens(get_analyzer(name, stop_words), c))
    return F.when(c.isNull(), 0).otherwise(length)


def terms_of_tokens(df, tokens: str, name: str, stop_words: Iterable[str] | None = None):
    """Rows with a column of single tokens to rows of terms: cleaned, without stop words, stemmed."""
    a = get_analyzer(name, stop_words)
    rows = df.withColumnRenamed(tokens, "term").where("term is not null")
    if a.clean:
        rows = rows.withColumn("term", a.clean(F.col("term"))).where("term <> ''")
    kept = a.kept(F.col("term"))
    if kept is not None:
        rows = rows.where(kept)
    if a.stem:
        rows = rows.withColumn("term", a.stem(F.col("term")))
    return rows


def explode_terms(df, id_col: str, text_col: str, name: str,
                  stop_words: Iterable[str] | None = None, keep: Iterable[str] = ()):
    """One row (doc_id, dl, term, pos) per term; dl is the number of terms kept.

    The token array is its own column before it is exploded, so each text is
    cut once and does not travel with its terms. Columns named in `keep` do.
    """
    a = get_analyzer(name, stop_words)
    text = F.col(text_col)
    cut = df.where(text.isNotNull()).select(
        F.col(id_col).alias("doc_id"), *keep, a.tokens(text).alias("tokens"))
    clean = a.clean or (lambda t: t)
    dl = F.size("tokens") if not (a.clean or a.stops) else F.size(
        F.filter("tokens", lambda t: _keeps(a, clean(t))))
    rows = (cut.withColumn("dl", dl)
            # outer: the inner form would cut every text once more in a filter
            .select("doc_id", "dl", *keep, F.posexplode_outer("tokens").alias("pos", "token")))
    return terms_of_tokens(rows, "token", name, stop_words)
