"""Main text of web pages: a recurrent labeller reads the blocks of a whole page."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.batches import map_batches
from corpuslink.llm.wordpieces import Store

MARKS = (r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*+>|"
         r"<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*+)(?P<attrs>%s*+)>")
#: A tag; a quoted > does not end it. After one that never ends, tags hold no further <.
TOKEN = re.compile(MARKS % r"(?:\"[^\"]*\"|'[^']*'|[^'\">])", re.S)
LOOSE = re.compile(MARKS % r"[^<>]", re.S)
UNQUOTED = re.compile(r"=\s*[^\s\"'>]*/\s*$")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+")
#: Fixed values of HTML: elements without an end tag, without readable text, and that part blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style noscript template head title svg math iframe object textarea select".split())
#: Fixed values of HTML: silent elements that take all that follows if they never end.
RAW = ("script", "style", "textarea", "title")
BLOCK = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p
    pre section summary table tbody td tfoot th thead tr ul""".split())
#: Names that decide the labels of training blocks: the nearest ancestor with one wins.
BOILER_TAGS = ("nav", "header", "footer", "aside", "form", "button", "menu", "dialog")
BOILER_NAMES = """nav navigation navbar menu breadcrumb header masthead footer sidebar aside widget ad ads advert
    advertisement sponsor promo banner cookie consent notice notification alert popup modal comment comments
    reply disqus discussion subscribe newsletter signup login search share social related recommended form
    copyright legal toolbar pagination""".split()
CONTENT_TAGS = ("article", "main")
CONTENT_NAMES = "article content main post entry story".split()

#: Innermost elements that main text and boilerplate both use.
LEAVES = "p p p div li h1 h2 h3 span td blockquote section".split()

PATH, WORDS, EXTRA, HIDDEN = 256, 32, 4, 16
INPUT = PATH + WORDS + EXTRA


@dataclass
class Block:
    """A run of text between block borders: its text, linked characters and ancestors."""

    text: str
    linked: int
    path: list[tuple[str, tuple[str, ...]]]


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order; character references decoded, white space made one space.

    A p ends where the next block element begins; an end tag ends all that is open
    inside it and is passed over if nothing of its name is open. Text of silent
    elements is no block; of those that never end, only `RAW` ones take the rest of the page,
    and a self-closed one holds nothing. Broken markup never fails; a page is read once,
    whatever it leaves open.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    is_open: Counter[str] = Counter()
    endless: set[str] = set()
    pieces: list[str] = []
    linked = at = 0
    mark, last = TOKEN, page.rfind(">")

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Block(text, min(linked, len(text)), list(stack)))
        pieces.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if is_open["a"]:
                linked += len(text)

    def cut(depth: int) -> None:
        is_open.subtract(t for t, _ in stack[depth:])
        del stack[depth:]

    seek = 0
    while (seek := page.find("<", seek)) >= 0:
        m = mark.match(page, seek) if seek < last or page[seek:seek + 3] in ("<!-", "<![") else None
        if not m:
            if mark is TOKEN and seek < last and page[seek + 1:seek + 3].lstrip("/")[:1].isalpha():
                mark = LOOSE
            else:
                seek += 1
            continue
        say(page[at:m.start()])
        at = seek = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if tag in BLOCK:
                flush()
            if is_open[tag]:
                cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            continue
        closed = m["attrs"].rstrip().endswith("/") and not UNQUOTED.search(m["attrs"])
        if tag in SILENT:
            if tag != "head":  # what a head holds is silent itself
                flush()
                if not (closed and tag in ("svg", "math")) and tag not in endless:
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                    if end:
                        at = end.end()
                    elif tag in RAW:
                        at = len(page)
                    else:
                        endless.add(tag)
                seek = at
            continue
        if tag == "br":
            pieces.append(" ")
        if tag in BLOCK:
            flush()
            open_p = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCK), None)
            if open_p is not None and stack[open_p][0] == "p":
                cut(open_p)
        if tag not in VOID and not closed:
            names = " ".join("".join(g) for g in NAMED.findall(m["attrs"])).lower()
            stack.append((tag, tuple(PART.findall(names))))
            is_open[tag] += 1
    say(page[at:])
    flush()
    return out


def rule_label(block: Block) -> int:
    """1 for main text, for training: by the nearest telling ancestor, else by length and links."""
    for tag, names in reversed(block.path):
        if tag in BOILER_TAGS or any(n in BOILER_NAMES for n in names):
            return 0
        if tag in CONTENT_TAGS or any(n in CONTENT_NAMES for n in names):
            return 1
    return int(len(block.text) > 120 and 5 * block.linked < len(block.text))


def path_names(block: Block) -> list[str]:
    """What the labeller sees of the ancestors: tags, names, and the innermost tag once more."""
    seen = [t for t, _ in block.path] + ["." + n for _, names in block.path for n in names]
    return seen + ["leaf " + (block.path[-1][0] if block.path else "")]


def path_vector(names: list[str]) -> np.ndarray:
    v = np.zeros(PATH)
    v[[zlib.crc32(n.encode()) % PATH for n in names]] = 1
    return v


_bucket = Store(lambda w: zlib.crc32(w.encode()) % WORDS)


def text_vector(block: Block, place: float) -> np.ndarray:
    """Shares of hashed words, length, links, place on the page and a constant."""
    words = block.text.lower().split()
    v = np.bincount([_bucket[w] for w in words], minlength=WORDS) / len(words)
    return np.concatenate([v, [np.log1p(len(words)) / 5, block.linked / len(block.text), place, 1.0]])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Labeller:
    """A bidirectional LSTM with a logistic output for every block of a sequence."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(INPUT)
        self.w = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, scale, (INPUT, 4 * HIDDEN))
            self.w["h" + d] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            self.w["c" + d] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # forget gates start open
            self.w["o" + d] = rng.normal(0, 0.1, HIDDEN)
        self.w["out"] = np.zeros(1)

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str) -> list:
        """States of one direction; x is (time, batch, INPUT), masked steps keep the state."""
        h = c = np.zeros((x.shape[1], HIDDEN))
        given = x @ self.w["x" + d] + self.w["c" + d]
        steps = []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            a = given[t] + h @ self.w["h" + d]
            gates = sigmoid(a[:, :3 * HIDDEN])
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(a[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new_c = m * (f * c + i * g) + (1 - m) * c
            tc = np.tanh(new_c)
            new_h = m * (o * tc) + (1 - m) * h
            steps.append((t, i, f, o, g, tc, c, h, m, new_h))
            h, c = new_h, new_c
        return steps

    def logits(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, dict]:
        passes = {d: self._pass(x, mask, d) for d in "fb"}
        out = np.full(x.shape[:2], self.w["out"][0])
        for d, steps in passes.items():
            for s in steps:
                out[s[0]] += s[-1] @ self.w["o" + d]
        return out, passes

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        """Gradients of the mean logistic loss, back through both directions."""
        out, passes = self.logits(x, mask)
        error = (sigmoid(out) - y) * mask / mask.sum()
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["out"][0] = error.sum()
        for d, steps in passes.items():
            dh = dc = np.zeros((x.shape[1], HIDDEN))
            for t, i, f, o, g, tc, c, h, m, new_h in reversed(steps):
                grad["o" + d] += error[t] @ new_h
                dh = dh + error[t][:, None] * self.w["o" + d]
                dcell = dc + m * dh * o * (1 - tc * tc)
                a = np.concatenate([m * dcell * g * i * (1 - i), m * dcell * c * f * (1 - f),
                                    m * dh * tc * o * (1 - o), m * dcell * i * (1 - g * g)], axis=1)
                grad["x" + d] += x[t].T @ a
                grad["h" + d] += h.T @ a
                grad["c" + d] += a.sum(0)
                dh = a @ self.w["h" + d].T + (1 - m) * dh
                dc = m * dcell * f + (1 - m) * dc
        return grad

    def fit(self, sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, batch: int = 32,
            rate: float = 0.02, seed: int = 5) -> Labeller:
        """Adam over batches of sequences of similar length."""
        rng = np.random.default_rng(seed)
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k][1]))
        groups = [order[k:k + batch] for k in range(0, len(order), batch)]
        mean, var = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            for k in rng.permutation(len(groups)):
                x, mask = padded([sequences[s][0] for s in groups[k]])
                y = np.zeros(mask.shape)
                for b, s in enumerate(groups[k]):
                    y[:len(sequences[s][1]), b] = sequences[s][1]
                step += 1
                for name, g in self.gradients(x, mask, y).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    var[name] = 0.999 * var[name] + 0.001 * g * g
                    self.w[name] = self.w[name] - rate * (mean[name] / (1 - 0.9 ** step)) / (
                        np.sqrt(var[name] / (1 - 0.999 ** step)) + 1e-8)
        return self


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, rows))
    x, mask = np.zeros((longest, len(rows), INPUT)), np.zeros((longest, len(rows)))
    for b, r in enumerate(rows):
        x[:len(r), b], mask[:len(r), b] = r, 1
    return x, mask


def vectors(found: list[Block]) -> np.ndarray:
    n = len(found)
    return np.array([np.concatenate([path_vector(path_names(b)), text_vector(b, k / n)])
                     for k, b in enumerate(found)])


def varied(names: list[list[str]], texts: np.ndarray, labels: np.ndarray,
           rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A training sequence like a page's, under other containers and with more boilerplate.

    Main text moves to another content element; other blocks move to other boilerplate
    elements; some boilerplate is repeated at random places, inside the main text too.
    """
    homes = [*CONTENT_TAGS, *["." + n for n in CONTENT_NAMES]]
    home = [str(h) for h in rng.choice(homes, rng.integers(1, 3))]
    rows = []
    for seen, text, label in zip(names, texts, labels):
        kept = [s for s in seen if s.lstrip(".") not in (*CONTENT_TAGS, *CONTENT_NAMES, *BOILER_TAGS, *BOILER_NAMES)]
        if rng.random() < 0.5:
            leaf = str(rng.choice(LEAVES))
            kept = ["html", "body", leaf, "leaf " + leaf]
        away = str(rng.choice([*BOILER_TAGS, *["." + n for n in BOILER_NAMES]]))
        rows.append((kept + (home if label else [away]), text, label))
        if rng.random() < 0.2:
            inside = home if rng.random() < 0.7 else []
            other = texts[rng.integers(len(texts))]
            rows.insert(int(rng.integers(len(rows) + 1)), (kept + inside + [away], other, 0))
    n = len(rows)
    x = np.array([np.concatenate([path_vector(r[0]), r[1]]) for r in rows])
    x[:, -2] = np.arange(n) / n
    return x, np.array([r[2] for r in rows], float)


def fit_labeller(pages: DataFrame, html_col: str = "html", sample: int = 300, longest: int = 300,
                 copies: int = 4, seed: int = 11) -> Labeller | None:
    """Train on `sample` different pages, drawn by a hash of their html, of at most `longest` blocks.

    Copies are one page. If the pages drawn have no blocks, more are drawn. If all are
    longer, pieces of `longest` blocks stand for them, drawn by hash. Blocks are labelled
    by rules on telling elements; what the tasks send is one short row a block, of at
    most `sample` pages or pieces. Each page is read as it is and in `copies` variants.
    None if no page has a block.
    """
    rows = pages.select(F.xxhash64(f"`{html_col}`").alias("h"), F.col(f"`{html_col}`").alias("html")).where(
        "html is not null")
    order = rows.select("h").distinct().orderBy(F.pmod("h", F.lit(1 << 40)), "h")

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in ("long", "place", "names", "texts", "labels")}
            for h, page in zip(batch.column("h").to_pylist(), batch.column("html")):
                found = blocks(page.as_py())
                for at in range(0, len(found), longest):
                    piece = found[at:at + longest]
                    out["long"].append(len(found) > longest)
                    out["place"].append(zlib.crc32(f"{h} {at}".encode()))
                    out["names"].append([path_names(b) for b in piece])
                    out["texts"].append([text_vector(b, (at + k) / len(found)).tolist() for k, b in enumerate(piece)])
                    out["labels"].append([rule_label(b) for b in piece])
            return out

        return step

    schema = "long boolean, place bigint, names array<array<string>>, texts array<array<double>>, labels array<int>"
    got, take = [], sample
    while not got:
        chosen = [r.h for r in order.limit(take).collect()]
        drawn = rows.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("html").alias("html"))
        got = map_batches(drawn, make, schema).orderBy("long", "place").limit(sample).collect()
        if len(chosen) < take:
            break
        take *= 4
    short = [r for r in got if not r.long] or got
    got = sorted((r.names, r.texts, r.labels) for r in short)
    if not got:
        return None
    rng = np.random.default_rng(seed)
    sequences = []
    for names, texts, labels in got:
        texts, labels = np.array(texts), np.array(labels)
        own = np.array([np.concatenate([path_vector(n), t]) for n, t in zip(names, texts)])
        sequences.append((own, labels.astype(float)))
        sequences += [varied(names, texts, labels, rng) for _ in range(copies)]
    return Labeller().fit(sequences)


def main_text(pages: DataFrame, model: Labeller | None, id_col: str = "page_id", html_col: str = "html",
              keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Main text of every page: page_id, the columns `keep`, text and n_chars (code points).

    Every block of the whole page is labelled with both the blocks before and after it
    in view; those labelled main text are joined by two line feeds. Null and empty
    pages, pages without blocks, and all pages when there is no model, have an empty
    text. One row per input row; kept columns named like results are left out.
    """
    keep = tuple(c for c in keep if c not in ("page_id", "text", "n_chars"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{html_col}`").alias("html"),
                        *[F.col(f"`{c}`") for c in keep])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            texts = [""] * batch.num_rows
            pending: list[tuple[int, list[Block], np.ndarray]] = []

            def label() -> None:
                x, mask = padded([p[2] for p in pending])
                chosen = model.logits(x, mask)[0] > 0
                for b, (row, found, _) in enumerate(pending):
                    texts[row] = "\n\n".join(k.text for k, c in zip(found, chosen[:, b]) if c)
                pending.clear()

            parsed = [(row, blocks(p.as_py() or "")) for row, p in enumerate(batch.column("html"))] if model else []
            for row, found in sorted(parsed, key=lambda p: len(p[1])):
                if not found:
                    continue
                if pending and len(found) * (len(pending) + 1) > 20_000:  # bounds the padded table
                    label()
                pending.append((row, found, vectors(found)))
                if len(pending) == 256:
                    label()
            if pending:
                label()
            return {"page_id": batch.column("page_id"), "text": texts, "n_chars": [len(t) for t in texts],
                    **{c: batch.column(c) for c in keep}}

        return step

    kinds = dict(pages.dtypes)
    kept = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return map_batches(rows, make, f"page_id {kinds[id_col]}, {kept}text string, n_chars bigint")
