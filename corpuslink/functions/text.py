"""Scalar text, URL, date and caption functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .analysis import STANDARD, get_analyzer

# Hosts and patterns that decide the produced text.
FEED_A = "arxiv"
FEED_B = "pubmed"
FEED_A_HOST = "https://arxiv.org"
FEED_B_HOST = "https://pmc.ncbi.nlm.nih.gov"
ARTICLE_PREFIX = "PMC"
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
LATEX_COMMANDS = r"\\(text|emph|textbf|textit|math[a-z]+)"
TITLE_LENGTH = 150
EPOCH = "1970-01-01"


def clean_text(c: Column) -> Column:
    """Collapse every run of white space to one blank; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WHITESPACE, " "))


def alnum_only(c: Column) -> Column:
    """Lower-case and keep ASCII letters and digits; null becomes empty."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def strip_dot_zero(c: Column) -> Column:
    return F.regexp_replace(c, r"\.0$", "")


def to_number(c: Column) -> Column:
    """Text to DOUBLE; anything that is not a number becomes null."""
    suffixed = c.rlike(r"(?i)[0-9.][df]\s*$")
    number = F.when(~suffixed, c.try_cast("double"))
    return F.when(~F.isnan(number), number)


def blank_to_null(c: Column) -> Column:
    return F.when(clean_text(c) != "", c)


def positive_price(c: Column) -> Column:
    return F.when(c > 0, c)


def normalize_key(c: Column) -> Column:
    """Trimmed upper-case key; null stays null."""
    return F.upper(F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def safe_title(c: Column) -> Column:
    """Title usable as a file name, at most 150 characters."""
    plain = F.regexp_replace(F.replace(c, F.lit("$"), F.lit("")), LATEX_COMMANDS, "")
    legal = F.translate(plain, '{}[]^\\_/*?:"<>|', "")
    return F.trim(F.substring(clean_text(legal), 1, TITLE_LENGTH))


def last_segment(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def html_url(c: Column) -> Column:
    return F.replace(c, F.lit("/abs/"), F.lit("/html/"))


def article_id(c: Column) -> Column:
    return F.concat(F.lit(ARTICLE_PREFIX), c.cast("string"))


def article_url(c: Column) -> Column:
    return F.concat(F.lit(FEED_B_HOST + "/articles/"), article_id(c), F.lit("/"))


def stem_name(c: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(c, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def page_name(c: Column) -> Column:
    """Paper id of a landed page: the file name without `.html`."""
    return F.replace(c, F.lit(".html"), F.lit(""))


def image_url(src: Column, base_href: Column, feed: Column) -> Column:
    """Absolute image address under the rule of each feed."""
    src, base = F.coalesce(src, F.lit("")), F.coalesce(base_href, F.lit(""))
    base_url = F.when(base.startswith("/"), F.concat(F.lit(FEED_A_HOST), base)).otherwise(
        F.concat(F.lit(FEED_A_HOST + "/"), base))
    a = F.when((src != "") & (base != ""), F.concat(base_url, src)).otherwise("")
    b = (F.when(src == "", "").when(src.startswith("http"), src)
         .otherwise(F.concat(F.lit(FEED_B_HOST), src)))
    return F.when(feed == FEED_A, a).otherwise(b)


def compose_caption(label: Column, text: Column, feed: Column) -> Column:
    """Feed A: own caption then main caption. Feed B: label, unless repeated."""
    label, text = F.coalesce(label, F.lit("")), F.coalesce(text, F.lit(""))
    both = F.concat(label, F.lit(" "), text)
    b = F.when((label != "") & ~F.contains(text, label), both).otherwise(text)
    return F.when(feed == FEED_A, F.trim(both)).otherwise(b)


def preview(c: Column, n: int, always_dots: bool = False) -> Column:
    """First n characters on one line, with dots when something was cut."""
    c = F.coalesce(c, F.lit(""))
    head = F.replace(F.substring(c, 1, n), F.lit("\n"), F.lit(" "))
    dots = F.lit("...") if always_dots else F.when(F.length(c) > n, "...").otherwise("")
    return F.concat(head, dots)


def join_texts(c: Column) -> Column:
    """Text of an array field for display."""
    return F.array_join(c, " ")


def result_title(kind: Column, title: Column, slug: Column, caption: Column,
                 object_id: Column) -> Column:
    """Display title: documents by title, media by caption, then fallbacks."""
    filled = lambda c: F.when(c != "", c)
    docs = F.coalesce(filled(title), filled(slug), F.lit("Documento sconosciuto"))
    media = F.coalesce(
        F.when(caption != "", preview(F.trim(caption), 100)),
        F.when(object_id != "", F.concat(F.lit("Oggetto: "), object_id)),
        F.lit("Immagine senza descrizione"))
    return F.when(kind == "docs", docs).otherwise(media)


def publication_date(dates: Column) -> Column:
    """Date of an array of (pub_type, date_type, year, month, day) structs.

    The first `epub` entry wins, then the first `pub`/`ppub`. A missing month or
    day counts as 1; a date that does not exist becomes 1970-01-01.
    """
    first = lambda keep: F.get(F.filter(dates, keep), F.lit(0))
    chosen = F.coalesce(
        first(lambda d: F.coalesce(d["pub_type"] == "epub", F.lit(False))),
        first(lambda d: F.coalesce(d["date_type"] == "pub", F.lit(False))
              | F.coalesce(d["pub_type"] == "ppub", F.lit(False))))
    part = lambda name, default: F.coalesce(
        F.trim(chosen[name]).try_cast("int"), F.lit(default))
    year = part("year", 1970)
    stamp = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"),
                        F.lpad(part("month", 1).cast("string"), 2, "0"),
                        F.lpad(part("day", 1).cast("string"), 2, "0")).try_cast("timestamp")
    return F.coalesce(F.when(chosen.isNotNull() & year.between(1, 9999), stamp),
                      F.lit(EPOCH).cast("timestamp"))


def author_names(contribs: Column) -> Column:
    """`given surname` of every (kind, surname, given) struct of kind author."""
    authors = F.filter(contribs, lambda c: c["kind"] == "author")
    names = F.transform(authors, lambda c: F.trim(F.concat(
        F.coalesce(c["given"], F.lit("")), F.lit(" "), F.coalesce(c["surname"], F.lit("")))))
    return F.filter(names, lambda n: n != "")


def serialize_record(columns: list[str]) -> Column:
    """`COL name VAL value ...` in the given order."""
    return F.concat_ws(" ", *[
        F.concat(F.lit(f"COL {c} VAL "), F.coalesce(F.col(c).cast("string"), F.lit("")))
        for c in columns])


def highlight(text: Column, terms: Column, size: int = 200, pre: str = "<mark>",
              post: str = "</mark>", fallback: int = 300, analyzer: str = "standard",
              stop_words: tuple[str, ...] | None = None) -> Column:
    """One fragment of at most `size` characters around the first matched word.

    `terms` are terms of the analyser; a word matches if its own term is one of
    them, so stemmed hits are marked as they are found. The fragment starts at
    most ten pieces (words and gaps) and half of `size` before the hit, ends
    between two pieces, and marks every matched word. Without a hit the plain
    preview is returned.
    """
    found = get_analyzer(analyzer, stop_words)
    text = F.coalesce(text, F.lit(""))
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))
    bare = F.transform(pieces, lambda p: (found.clean or (lambda w: w))(F.lower(p)))
    if found.stem_all:
        bare = found.stem_all(bare)
    hits = F.transform(bare, lambda w: F.array_contains(terms, w))

    def fragment(x: Column) -> Column:
        first = F.array_position(x["hits"], True).cast("int")
        before = F.greatest(first - 10, F.lit(1))
        lead = F.length(F.array_join(F.slice(x["pieces"], before, first - before), ""))
        start = F.when(lead > size // 2, first).otherwise(before)
        shown, marks = F.slice(x["pieces"], start, F.lit(size)), F.slice(x["hits"], start, F.lit(size))
        fits = F.aggregate(shown, F.struct(F.lit(0).alias("n"), F.lit(0).alias("length")), lambda s, p: F.struct(
            (s["n"] + (s["length"] + F.length(p) <= size).cast("int")).alias("n"),
            (s["length"] + F.length(p)).alias("length")))["n"]
        n = F.greatest(fits, F.lit(1))
        marked = F.zip_with(F.slice(shown, F.lit(1), n), F.slice(marks, F.lit(1), n), lambda p, hit: F.when(
            hit, F.concat(F.lit(pre), p, F.lit(post))).otherwise(p))
        return F.when(first > 0, F.concat(F.lit("... "), F.array_join(marked, ""), F.lit(" ...")))

    # Pieces and hits are the one element of an array, so that they are made once.
    once = F.array(F.struct(pieces.alias("pieces"), hits.alias("hits")))
    return F.coalesce(F.get(F.transform(once, fragment), F.lit(0)), preview(text, fallback))


PIECES = rf"{STANDARD}|[^\p{{L}}\p{{N}}]+"
