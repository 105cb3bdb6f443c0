"""Stemmers: light Italian as Column expressions, Porter as an Arrow function."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def italian_light(term: Column) -> Column:
    """Savoy's light Italian stemmer: plain vowels, then drop the ending vowel.

    Words of fewer than six letters stay whole. A final `e` or `i` takes a
    preceding `h` or `i` with it, a final `a` or `o` a preceding `i`.
    """
    plain = F.translate(term, "àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii")
    return F.when(F.length(term) < 6, term).otherwise(
        F.regexp_replace(plain, "([ih]?[ei]|i?[ao])$", ""))


# Porter's letters-and-rules description (1980): a word is C?(VC)^m V?, where y
# counts as a vowel after a consonant.
_C, _V = "[^aeiou]", "[aeiouy]"
_CS, _VS = f"{_C}[^aeiouy]*", f"{_V}[aeiou]*"
_M1 = re.compile(f"^(?:{_CS})?{_VS}{_CS}")
_M1_ONLY = re.compile(f"^(?:{_CS})?{_VS}{_CS}(?:{_VS})?$")
_M2 = re.compile(f"^(?:{_CS})?{_VS}{_CS}{_VS}{_CS}")
_HAS_VOWEL = re.compile(f"^(?:{_CS})?{_V}")
_CVC = re.compile(f"^{_CS}{_V}[^aeiouwxy]$")

# Suffix tables of steps 2, 3 and 4.
_STEP2 = dict(ational="ate", tional="tion", enci="ence", anci="ance", izer="ize",
              bli="ble", alli="al", entli="ent", eli="e", ousli="ous", ization="ize",
              ation="ate", ator="ate", alism="al", iveness="ive", fulness="ful",
              ousness="ous", aliti="al", iviti="ive", biliti="ble", logi="log")
_STEP3 = dict(icate="ic", ative="", alize="al", iciti="ic", ical="ic", ful="", ness="")
_STEP4 = ("al ance ence er ic able ible ant ement ment ent sion tion ou ism ate iti "
          "ous ive ize").split()
_STEP1_E = ("at", "bl", "iz")


def _suffix(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def porter(word: str) -> str:
    """Porter stem of one lower-case word."""
    if len(word) < 3:
        return word
    w = "Y" + word[1:] if word[0] == "y" else word
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _M1.match(w[:-3]) else w
    else:
        ending = _suffix(w, ("ed", "ing"))
        if ending and _HAS_VOWEL.match(w[: -len(ending)]):
            w = w[: -len(ending)]
            if w.endswith(_STEP1_E):
                w += "e"
            elif re.search(r"([^aeiouylsz])\1$", w):
                w = w[:-1]
            elif _CVC.match(w):
                w += "e"
    if w.endswith("y") and _HAS_VOWEL.match(w[:-1]):
        w = w[:-1] + "i"
    for table in (_STEP2, _STEP3):
        ending = _suffix(w, table)
        if ending and _M1.match(w[: -len(ending)]):
            w = w[: -len(ending)] + table[ending]
    ending = _suffix(w, _STEP4)
    if ending:
        stem = w[: -len(ending)] + (ending[0] if ending in ("sion", "tion") else "")
        w = stem if _M2.match(stem) else w
    if w.endswith("e"):
        stem = w[:-1]
        if _M2.match(stem) or (_M1_ONLY.match(stem) and not _CVC.match(stem)):
            w = stem
    if w.endswith("ll") and _M2.match(w):
        w = w[:-1]
    return w.lower()


@F.pandas_udf(T.StringType())
def porter_stem(terms: pd.Series) -> pd.Series:
    """Porter stem; each distinct word of a batch is stemmed once."""
    stems = {t: porter(t) for t in terms.dropna().unique()}
    return terms.map(stems)


@F.pandas_udf(T.ArrayType(T.StringType()))
def porter_stem_all(terms: pd.Series) -> pd.Series:
    """Porter stem of every word of an array."""
    stems = {t: porter(t) for t in {t for ts in terms.dropna() for t in ts}}
    return terms.map(lambda ts: None if ts is None else [stems[t] for t in ts])
