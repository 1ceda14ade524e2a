"""Text analysis as DataFrame transforms: tokens (with or without offsets),
lower-casing, ASCII folding, stop words and optional stemming.

The index path never needs offsets, so it is a plain ``explode`` of
``regexp_extract_all`` inside the scan stage (no shuffle).  Offsets are only
computed for the few documents a highlighter touches.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stem as stem_fn
from ..functions.text import (MAX_TOKEN_CHARS, SPARK_TOKEN_PATTERN, java_split_space, normalize_term, split_long,
                              strip_accents, token_array)

SEP = "\u0001"


@dataclass
class Analyzer:
    """Analysis chain: tokenise -> lower -> fold -> stop -> (stem).

    ``stopwords`` is a DataFrame with one string column ``word`` holding the
    stop *set* (see :func:`stopword_set`), or None for no stop words.
    """

    stopwords: DataFrame | None = None
    fold: bool = True
    stem: bool = False

    def normalize(self, token: Column) -> Column:
        t = normalize_term(token) if self.fold else F.lower(token)
        return t

    def finish(self, term: Column) -> Column:
        """Per-term step after the stop filter."""
        return stem_fn.romanian_stem(term) if self.stem else term

    def stop_side(self) -> DataFrame | None:
        """Stop set as a join side (the planner broadcasts what is small)."""
        return None if self.stopwords is None else self.stopwords.select("word")

    def stop_array(self) -> DataFrame:
        """One-row DataFrame ``stop_arr ARRAY<STRING>`` (empty when no stop words).

        Exactly one row (global aggregate); the array holds the stop set, a
        list that people write."""
        side = self.stop_side()
        if side is None:
            spark = SparkSession.getActiveSession()
            return spark.range(1).select(F.array().cast("array<string>").alias("stop_arr"))
        return side.agg(F.coalesce(F.collect_set("word"), F.array().cast("array<string>")).alias("stop_arr"))


def stopword_set(words: DataFrame, col: str = "word") -> DataFrame:
    """Stop set from a list of words: every word plus its accent-stripped form."""
    w = words.select(F.col(col).alias("word")).where(F.col("word").isNotNull())
    return w.unionByName(w.select(strip_accents(F.col("word")).alias("word"))).distinct()


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line (UTF-8) -> stop set."""
    return stopword_set(spark.read.text(path).withColumnRenamed("value", "word"))


def tokens(df: DataFrame, id_cols: Sequence[str], text_col: str = "content") -> DataFrame:
    """(ids..., token_no, token): one row per token, numbered from 0."""
    return df.select(*id_cols, F.posexplode(token_array(F.col(text_col))).alias("token_no", "token"))


def tokenize_offsets(df: DataFrame, id_cols: Sequence[str], text_col: str = "content", with_words: bool = False) -> DataFrame:
    """(ids..., token_no, token, start, end): tokens with character offsets,
    and on demand ``word_no``, the number of blanks before the token.

    The text is cut into alternating gap/token pieces; a token's start is the
    running length of the pieces before it (a window per text, so use it on
    the documents you need offsets for, e.g. the hits of a search)."""
    text = F.translate(F.col(text_col), SEP, " ")
    pieces = F.split(F.regexp_replace(text, SPARK_TOKEN_PATTERN, SEP + "$0" + SEP), SEP)
    # gaps and tokens take turns; the parts of a long token get an empty gap between them
    parts = F.flatten(F.transform(pieces, lambda p, k: F.when((k % 2 == 0) | (F.length(p) <= MAX_TOKEN_CHARS), F.array(p)).otherwise(
        F.flatten(F.transform(split_long(p), lambda x, j: F.when(j == 0, F.array(x)).otherwise(F.array(F.lit(""), x)))))))
    exploded = df.select(*id_cols, F.posexplode(parts).alias("piece_no", "piece"))
    w = Window.partitionBy(*id_cols).orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)
    with_start = exploded.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(w), F.lit(0)).cast("int"))
    more = []
    if with_words:
        blanks = F.length("piece") - F.length(F.replace("piece", F.lit(" ")))
        with_start = with_start.withColumn("word_no", F.coalesce(F.sum(blanks).over(w), F.lit(0)).cast("int"))
        more = ["word_no"]
    return with_start.where(F.col("piece_no") % 2 == 1).select(
        *id_cols,
        ((F.col("piece_no") - 1) / 2).cast("int").alias("token_no"),
        F.col("piece").alias("token"),
        F.col("start"),
        (F.col("start") + F.length("piece")).cast("int").alias("end"),
        *more,
    )


def remove_stopwords(df: DataFrame, analyzer: Analyzer, col: str = "term") -> DataFrame:
    side = analyzer.stop_side()
    if side is None:
        return df
    return df.join(side.withColumnRenamed("word", col), on=col, how="left_anti")


def analyze_tokens(tok: DataFrame, analyzer: Analyzer, token_col: str = "token") -> DataFrame:
    """Token rows -> term rows (normalised, stop words removed, stemmed)."""
    terms = tok.withColumn("term", analyzer.normalize(F.col(token_col))).where(F.col("term").isNotNull())
    terms = remove_stopwords(terms, analyzer)
    if analyzer.stem:
        terms = terms.withColumn("term", analyzer.finish(F.col("term")))
    return terms


def stemmed(terms: DataFrame, stems: DataFrame | None = None) -> DataFrame:
    """Term rows with every term stemmed, each distinct term once (a corpus has
    far fewer terms than tokens; a small batch of queries stems in place).

    ``stems``: the (term, stem) of all their terms, where they are known."""
    stems = stem_vocabulary(terms) if stems is None else stems
    return terms.join(stems, "term").select(*(F.col("stem").alias(c) if c == "term" else F.col(c) for c in terms.columns))


def analyze(df: DataFrame, analyzer: Analyzer, id_cols: Sequence[str] = ("doc_id",),
            text_col: str = "content", positions: bool = True) -> DataFrame:
    """(ids..., [token_no,] term) for every surviving token of every text."""
    if positions:
        tok = tokens(df, id_cols, text_col)
    else:
        tok = df.select(*id_cols, F.explode(token_array(F.col(text_col))).alias("token"))
    out = analyze_tokens(tok, analyzer)
    keep = [*id_cols, "token_no", "term"] if positions else [*id_cols, "term"]
    return out.select(*keep)


def first_term(word: Column, stop_arr: Column, analyzer: Analyzer) -> Column:
    """First term a single word analyses to, '' when none survives (array form,
    for use inside higher-order functions)."""
    ts = F.transform(token_array(word), lambda t: analyzer.normalize(t))
    ts = F.filter(ts, lambda t: ~F.array_contains(stop_arr, t))
    first = F.coalesce(F.try_element_at(ts, F.lit(1)), F.lit(""))
    if analyzer.stem:
        first = F.when(first == "", first).otherwise(analyzer.finish(first))
    return first


#: A word that is one token of ASCII letters, perhaps with a sign after it.
PLAIN_WORD = r"^([A-Za-z]{1,255})[.,;:!?]?$"


def first_term_of_column(word: Column, stop_arr: Column, analyzer: Analyzer) -> Column:
    """As :func:`first_term`, for a column of words: plain ones need no tokeniser."""
    plain = F.lower(F.regexp_extract(word, PLAIN_WORD, 1))
    kept = F.when(F.array_contains(stop_arr, plain), "").otherwise(analyzer.finish(plain))
    return F.when(plain != "", kept).otherwise(first_term(word, stop_arr, analyzer))


def first_term_of_words(df: DataFrame, analyzer: Analyzer, id_cols: Sequence[str] = ("doc_id",),
                        text_col: str = "content") -> DataFrame:
    """(ids..., word_no, word, term): every space-separated word of a text with
    the first term it analyses to ('' if none); newlines count as spaces."""
    stop = analyzer.stop_array()
    words = df.select(*id_cols, F.posexplode(java_split_space(F.translate(F.col(text_col), "\n", " ")))
                      .alias("word_no", "word"))
    return words.crossJoin(stop).select(
        *id_cols, "word_no", "word", first_term_of_column(F.col("word"), F.col("stop_arr"), analyzer).alias("term"))


def stem_vocabulary(terms: DataFrame, col: str = "term") -> DataFrame:
    """(term, stem) for the distinct terms of a table."""
    return terms.select(F.col(col).alias("term")).distinct().select("term", stem_fn.romanian_stem(F.col("term")).alias("stem"))
