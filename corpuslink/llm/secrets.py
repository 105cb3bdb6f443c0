"""Secrets in texts: fixed patterns, and strings that a battery of tests finds random."""

from __future__ import annotations

import math
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.batches import id_and_text, map_batches
from corpuslink.operators.scale import materialize

KINDS = ("assign", "access", "hex", "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"(?P<name>(?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Strings that may be encoded bytes.
CODED = re.compile(r"[A-Za-z0-9+/_-]{12,}")

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
#: Encodings from the smallest alphabet up; the first that holds all characters is taken.
ALPHABETS = (DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER, UPPER, UPPER + "234567",
             DIGITS + LOWER, DIGITS + UPPER, UPPER + LOWER, UPPER + LOWER + DIGITS,
             UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_",
             UPPER + LOWER + DIGITS + "+/-_")
#: Letters of ordinary English text, in percent, a to z.
LETTER_PERCENT = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
                  6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: Of ordinary names and words: shares of the classes, and of neighbours of different classes.
CLASS_SHARE = {"lower": 0.86, "upper": 0.06, "digit": 0.06, "sign": 0.02}
CLASS_CHANGE = 0.15
#: A random string is refused by one of its own tests this seldom.
REFUSE = 1e-3
STRATUM, STRATA, BINS = 8, 16, 400


def _class(c: str) -> str:
    return ("lower" if c in LOWER else "upper" if c in UPPER else "digit" if c in DIGITS else "sign")


def _text_shares(alphabet: str) -> np.ndarray:
    """How often ordinary words and names use each character of an alphabet."""
    letters = np.array(LETTER_PERCENT) / sum(LETTER_PERCENT)
    raw = []
    for c in alphabet:
        kind = _class(c)
        spread = letters[ord(c.lower()) - 97] if kind in ("lower", "upper") else 0.1 if kind == "digit" else 0.25
        raw.append(CLASS_SHARE[kind] * spread)
    return np.array(raw) / sum(raw)


SHARES = [_text_shares(a) for a in ALPHABETS]


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared, by the cube-root approximation."""
    return _upper_tail(((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def battery(text: str) -> float:
    """How likely an ordinary word or name would look as random as this; 1 if it is not random.

    The encoding is inferred. If the string were random in it, the chi-squared test of
    the uniform alphabet, the runs test about the median and the serial correlation
    should not refuse it: where one does, the answer is 1. Else two of the statistics
    are held against ordinary text: chi-squared against its mean and variance under the
    letter shares of text, and the changes between character classes against a
    binomial of few changes. Both tails are combined by Fisher's rule.
    """
    which = next(k for k, a in enumerate(ALPHABETS) if set(text) <= set(a))
    alphabet, n = ALPHABETS[which], len(text)
    codes = np.array([alphabet.index(c) for c in text])
    k = len(alphabet)
    chi = float((np.bincount(codes, minlength=k) ** 2).sum()) * k / n - n
    if _chi_tail(max(chi, 1e-9), k - 1) < REFUSE:
        return 1.0
    high = codes >= k / 2
    ones = int(high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * ones * (n - ones) / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    if var <= 0 or 2 * _upper_tail(abs(runs - mean) / math.sqrt(var)) < REFUSE:
        return 1.0
    off = codes - codes.mean()
    serial = float((off[1:] * off[:-1]).sum() / (off * off).sum())
    if 2 * _upper_tail(abs(serial) * math.sqrt(n)) < REFUSE:
        return 1.0
    f = SHARES[which]
    s2, s3 = float((f ** 2).sum()), float((f ** 3).sum())
    text_mean = k * (1 - s2) + n * (k * s2 - 1)
    text_var = 4 * n * k * k * (s3 - s2 * s2) + 2 * (k - 1)
    p_chi = _upper_tail((text_mean - chi) / math.sqrt(text_var))
    kinds = [_class(c) for c in text]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    p_runs = _upper_tail((changes - 0.5 - CLASS_CHANGE * (n - 1))
                         / math.sqrt(CLASS_CHANGE * (1 - CLASS_CHANGE) * (n - 1)))
    both = max(p_chi, 1e-150) * max(p_runs, 1e-150)  # never rounded to zero, however long the string is
    return min(1.0, both * (1 - math.log(both)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, leftmost first in each kind."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row the base spans, and the tested strings with their likelihood and length stratum."""
    def make():
        def step(batch: pa.RecordBatch) -> dict:
            base, tested = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                tested.append([{"start": m.start(), "end": m.end(), "p": battery(m[0]),
                                "stratum": min(STRATA - 1, len(m[0]) // STRATUM)}
                               for m in CODED.finditer(text)
                               if not any(a < m.end() and m.start() < b for a, _, b in spans)])
            return {"doc_id": batch.column("doc_id"), "base": base, "tested": tested}

        return step

    kind = dict(docs.dtypes)[id_col]
    return map_batches(id_and_text(docs, id_col, text_col), make, f"""doc_id {kind},
        base array<struct<start: int, kind: int, end: int>>,
        tested array<struct<start: int, end: int, p: double, stratum: int>>""")


def _log_bin(p) -> F.Column:
    """Bins of equal width in the logarithm; bin b holds p <= 10 ** (-b / 10)."""
    return F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300))) + 1e-9)).cast("int")


def discovery_bins(counts: list[tuple[int, int, int]], rate: float) -> dict[int, int]:
    """The least bin of each length stratum that a false-discovery rate allows.

    `counts` are (stratum, bin, strings). A stratum weighs as much as its length, and the
    weights average 1 over all strings, so longer strings, which the tests tell apart
    better, need less evidence: Benjamini-Hochberg over p divided by the weight.
    """
    total = sum(n for _, _, n in counts)
    mean = sum((s + 1) * n for s, _, n in counts) / total if total else 1
    weight = {s: (s + 1) / mean for s in range(STRATA)}
    best = None
    for step in range(BINS + 1):
        cut = 10 ** (-step / 10)
        found = sum(n for s, b, n in counts if 10 ** (-b / 10) <= cut * weight[s])
        if found and total * cut <= rate * found:
            best = cut
            break
    if best is None:
        return {s: BINS + 1 for s in weight}
    return {s: max(1, math.ceil(-10 * math.log10(min(1.0, best * w)) - 1e-9)) for s, w in weight.items()}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rate: float = 0.01) -> DataFrame:
    """Secrets of every whole text: doc_id, base and spans, one row per input row.

    Both are arrays of (start, kind, end), sorted, in code points, the end exclusive; kind
    is an index of `KINDS`. `base` holds what the fixed patterns find, `spans` also what
    the battery finds among encoded strings of 12 or more characters that no base span
    meets, at a false-discovery rate of `rate` over the whole table. Only counts by
    length and likelihood reach the driver, at most 16 x 401. Null and empty texts hold
    nothing; repeated rows are answered alike.
    """
    found = materialize(scan(docs, id_col, text_col))
    each = found.select(F.explode("tested").alias("t")).select("t.stratum", _log_bin(F.col("t.p")).alias("bin"))
    counts = [tuple(r) for r in each.groupBy("stratum", "bin").agg(F.count("*").alias("n")).collect()]
    bins = discovery_bins(counts, rate)
    least = F.array(*[F.lit(bins[s]) for s in range(STRATA)])
    shown = F.transform(F.filter("tested", lambda t: _log_bin(t["p"]) >= F.get(least, t["stratum"])),
                        lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"),
                                           t["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", shown)).alias("spans"))
