"""Relevance scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the ranking function.
K1 = 1.2
B = 0.75
EXACT_LENGTHS = 24


def quantize_length(dl: Column) -> Column:
    """Field length as the one-byte norm keeps it.

    Lengths below 40 are exact; beyond, `dl - 24` keeps its four leading bits.
    """
    over = (dl - EXACT_LENGTHS).cast("int")
    shift = F.length(F.bin(over)) - 4
    step = F.pow(F.lit(2.0), shift)
    coarse = EXACT_LENGTHS + F.floor(over / step) * step
    return F.when(dl < 40, dl).otherwise(coarse).cast("int")


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def bm25(tf: Column, df: Column, n: Column, dl: Column, avgdl: Column,
         norms: Column | bool = True) -> Column:
    """BM25 with quantised lengths; fields without norms ignore the length."""
    norms = norms if isinstance(norms, Column) else F.lit(norms)
    length = F.when(norms, 1 - B + B * quantize_length(dl) / avgdl).otherwise(1.0)
    return idf(n, df) * (K1 + 1) * tf / (tf + K1 * length)


def smooth_idf(n: Column, df: Column) -> Column:
    """Inverse document frequency of the TF-IDF weights."""
    return F.log((1 + n) / (1 + df)) + 1
