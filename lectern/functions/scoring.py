"""Scoring formulas as column expressions (BM25, IDF, TF weight)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# BM25 parameters of the default similarity.
BM25_K1 = 1.2
BM25_B = 0.75
# Document lengths below this are stored exactly by the lossy length norm.
NORM_FREE_VALUES = 24
# Decimal places used to compare scores (float32 in the original engine).
SCORE_DECIMALS = 6
# ---------------------------------------------------------------------------


def bm25_idf(n_docs: Column, df: Column) -> Column:
    """ln(1 + (N - df + 0.5) / (df + 0.5))."""
    n = n_docs.cast("double")
    d = df.cast("double")
    return F.log(F.lit(1.0) + (n - d + F.lit(0.5)) / (d + F.lit(0.5)))


def bm25_tf_norm(tf: Column, dl: Column, avgdl: Column,
                 k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))."""
    t = tf.cast("double")
    return t * F.lit(k1 + 1.0) / (t + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl.cast("double") / avgdl))


def bm25(tf: Column, dl: Column, df: Column, n_docs: Column, avgdl: Column,
         boost: Column | float = 1.0) -> Column:
    boost_c = boost if isinstance(boost, Column) else F.lit(float(boost))
    return boost_c * bm25_idf(n_docs, df) * bm25_tf_norm(tf, dl, avgdl)


def quantized_length(dl: Column) -> Column:
    """Length as the lossy one-byte norm decodes it: exact below 40, else the
    part above 24 keeps its top four bits."""
    m = dl.cast("long") - F.lit(NORM_FREE_VALUES)
    step = F.pow(F.lit(2.0), F.length(F.bin(m)) - F.lit(4))
    lossy = F.lit(NORM_FREE_VALUES) + (F.floor(m / step) * step).cast("long")
    return F.when(m < 16, dl.cast("long")).otherwise(lossy)


def round_score(score: Column) -> Column:
    return F.round(score, SCORE_DECIMALS)


def idf_log10(num_docs: Column, df: Column) -> Column:
    """log10(N / df); a word found nowhere has IDF +Infinity."""
    return F.when(df == 0, F.lit(math.inf)).otherwise(
        F.log10(num_docs.cast("double") / df.cast("double")))


def tf_weight(count: Column) -> Column:
    """1 + log10(count) when the key is in the document, else 0."""
    return F.when(count.isNotNull() & (count > 0), F.lit(1.0) + F.log10(count.cast("double"))).otherwise(F.lit(0.0))


# --- SQL text for the DuckDB oracle -------------------------------------------

def quantized_length_sql(dl: str) -> str:
    m = f"({dl} - {NORM_FREE_VALUES})"
    shift = f"(length(bin({m})) - 4)"
    return f"(CASE WHEN {m} < 16 THEN {dl} ELSE {NORM_FREE_VALUES} + (({m} >> {shift}) << {shift}) END)"
