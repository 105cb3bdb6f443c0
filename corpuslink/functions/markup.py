"""HTML and XML read into rows. These helpers only turn one markup string into
flat records; what counts as a figure, mention or author is decided in Spark."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML elements without content, and hidden content.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("script style template".split())
NOT_TEXT = set("script style head".split())
TRACKED = set("a base div figcaption figure h3 h4 img p section strong table".split())

ELEMENT_SCHEMA = T.StructType([
    T.StructField("node", T.IntegerType()), T.StructField("tag", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("cls", T.StringType()),
    T.StructField("href", T.StringType()), T.StructField("src", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("spaced", T.StringType()),
    T.StructField("path", T.ArrayType(T.StructType([
        T.StructField("node", T.IntegerType()), T.StructField("tag", T.StringType()),
        T.StructField("cls", T.StringType())])))])


class _Reader(HTMLParser):
    """Open elements, text pieces and finished tracked elements of one page.

    A new `p` closes an open one; an end tag closes everything inside it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.pieces: list[str] = []
        self.visible: list[str] = []
        self.done: list[dict] = []
        self.count = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "p":
            self._close("p")
        given = {k: v or "" for k, v in attrs}
        cls = " ".join(given.get("class", "").split())
        tracked = tag in TRACKED or "caption" in cls.split()
        here = {"tag": tag, "node": self.count, "cls": cls, "id": given.get("id", "").strip(),
                "href": given.get("href"), "src": given.get("src", "").strip(),
                "first": len(self.pieces), "tracked": tracked}
        self.count += 1
        if tracked:
            here["path"] = [{"node": e["node"], "tag": e["tag"], "cls": e["cls"]}
                            for e in self.open if e["tracked"]] + [
                                {"node": here["node"], "tag": tag, "cls": cls}]
        self.open.append(here)
        if tag in VOID:
            self._finish(self.open.pop())

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(tag)

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def handle_data(self, data: str) -> None:
        inside = {e["tag"] for e in self.open}
        if not inside & HIDDEN:
            self.pieces.append(data)
        if not inside & NOT_TEXT:
            self.visible.append(data)

    def _close(self, tag: str) -> None:
        if any(e["tag"] == tag for e in self.open):
            while self.open:
                e = self.open.pop()
                self._finish(e)
                if e["tag"] == tag:
                    return

    def _finish(self, e: dict) -> None:
        if e["tracked"]:
            pieces = self.pieces[e["first"]:]
            e["text"] = "".join(pieces)
            e["spaced"] = " ".join(pieces) if e["tag"] == "table" else None
            self.done.append(e)

    def read(self, html: str) -> None:
        self.feed(html)
        self.close()
        while self.open:
            self._finish(self.open.pop())


def _elements(html: str) -> Iterator[dict]:
    reader = _Reader()
    reader.read(html or "")
    for e in reader.done:
        texted = e["tag"] not in ("div", "section", "figure") or "caption" in e["cls"].split()
        yield {"node": e["node"], "tag": e["tag"], "id": e["id"], "cls": e["cls"],
               "href": e["href"], "src": e["src"], "text": e["text"] if texted else None,
               "spaced": e["spaced"], "path": e["path"]}


#: Rows that go back to Spark together, and characters of the markup that they come from.
ROWS_AT_ONCE, CHARS_AT_ONCE = 1_000, 1 << 22


def _slices(markup: pd.Series) -> Iterator[pd.Series]:
    """Consecutive parts of a batch, each with few rows and characters; a longer text stands alone."""
    at, n, chars = 0, 0, 0
    for k, text in enumerate(markup):
        size = len(text) if isinstance(text, str) else 0
        if n and (n == ROWS_AT_ONCE or chars + size > CHARS_AT_ONCE):
            yield markup.iloc[at:k]
            at, n, chars = k, 0, 0
        n, chars = n + 1, chars + size
    yield markup.iloc[at:]


def html_elements(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """Tracked elements of each page, parsed once: keys, node number in document
    order, tag, id, class, link, text, and the path of enclosing elements."""
    schema = T.StructType([pages.schema[k] for k in keys] + ELEMENT_SCHEMA.fields)
    names = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, chars = [], 0
            for page in batch.itertuples(index=False):
                head = dict(zip(keys, page[:-1]))
                rows += [{**head, **e} for e in _elements(page[-1])]
                chars += len(page[-1] or "")
                if len(rows) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE:
                    yield pd.DataFrame(rows, columns=names)
                    rows, chars = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return pages.select(*keys, html).mapInPandas(run, schema)


@F.pandas_udf(T.StringType())
def visible_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """All text of a page outside script, style and head."""
    def one(page: str | None) -> str | None:
        if page is None:
            return None
        reader = _Reader()
        reader.read(page)
        return "".join(reader.visible)

    for batch in batches:
        for html in _slices(batch):
            yield html.map(one)


ARTICLE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("contribs", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("surname", T.StringType()),
        T.StructField("given", T.StringType())]))),
    T.StructField("abstract", T.StringType()),
    T.StructField("dates", T.ArrayType(T.StructType([
        T.StructField("pub_type", T.StringType()), T.StructField("date_type", T.StringType()),
        T.StructField("year", T.StringType()), T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType())]))),
    T.StructField("body", T.StringType())])


def _text(node: ET.Element | None, default: str = "") -> str:
    return default if node is None else "".join(node.itertext()).strip()


def _article(xml: str | None) -> dict:
    empty = {"status": "malformed", "title": None, "contribs": [], "abstract": None,
             "dates": [], "body": None}
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return empty
    abstract = root.find(".//abstract")
    if abstract is not None:
        for heading in abstract.findall("title"):
            heading.text = ""
    return {
        "status": "ok", "title": _text(root.find(".//article-title")),
        "contribs": [{"kind": c.get("contrib-type"), "surname": _text(c.find("name/surname")),
                      "given": _text(c.find("name/given-names"))}
                     for c in root.iter("contrib") if c.find("name") is not None],
        "abstract": _text(abstract), "body": _text(root.find(".//body")),
        "dates": [{"pub_type": d.get("pub-type"), "date_type": d.get("date-type"),
                   **{part: d.findtext(part) for part in ("year", "month", "day")}}
                  for d in root.iter("pub-date")]}


@F.pandas_udf(ARTICLE_SCHEMA)
def article_parts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Title, contributors, abstract, dates and body of article XML; broken XML
    gives the status `malformed`."""
    for batch in batches:
        for xml in _slices(batch):
            yield pd.DataFrame([_article(x) for x in xml], columns=ARTICLE_SCHEMA.names)


def xml_text_udf(path: str, default: str = ""):
    """Function for all text under the first node of a path."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(x: str | None) -> str:
            try:
                node = ET.fromstring(x or "").find(path)
            except ET.ParseError:
                return default
            return _text(node, default)

        for batch in batches:
            for xml in _slices(batch):
                yield xml.map(one)

    return run
