"""Column predicates over free-text query strings (no parser is built).

A free-text query is a batch row ``(query_id, query)``; its words are the
space-separated pieces.  Boolean, prefix, fuzzy, range ... operators come as a
clause table instead (see :mod:`lectern.operators.match`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import java_split_space, java_split_space_sql

# --- fixed values -----------------------------------------------------------
# Words that cannot stand alone in the query syntax.
LONE_OPERATORS = ["&&", "||", "+", "-", "!", "*"]
# The one word that may start with a wildcard (match all documents).
MATCH_ALL = "*:*"
# ---------------------------------------------------------------------------


def _count(word: Column, ch: str) -> Column:
    return F.length(word) - F.length(F.replace(word, F.lit(ch), F.lit("")))


def _word_is_bad(w: Column) -> Column:
    opens = _count(w, "(")
    closes = _count(w, ")")
    sq_open = _count(w, "[") + _count(w, "{")
    sq_close = _count(w, "]") + _count(w, "}")
    quotes = _count(w, '"')
    return (
        w.isin(*LONE_OPERATORS)
        | ((w.startswith("*") | w.startswith("?")) & (w != MATCH_ALL))
        | (opens != closes)
        | (sq_open != sq_close)
        | (quotes % 2 == 1)
    )


def query_is_valid(query: Column) -> Column:
    """False for the query strings that fail as a whole: empty, a leading or
    double space (an empty word), a lone operator, a leading wildcard or
    unbalanced quotes/brackets within one word.  Trailing spaces are harmless."""
    q = F.regexp_replace(query, " +$", "")
    words = java_split_space(q)
    bad = (q == "") | q.startswith(" ") | q.contains("  ") | F.exists(words, _word_is_bad)
    return ~bad


def _count_sql(w: str, ch: str) -> str:
    return f"(length({w}) - length(replace({w}, '{ch}', '')))"


def query_is_valid_sql(q: str) -> str:
    qs = f"regexp_replace({q}, ' +$', '')"
    ops = ", ".join("'" + o + "'" for o in LONE_OPERATORS)
    w = "w"
    bad_word = (f"({w} IN ({ops}) OR ((starts_with({w}, '*') OR starts_with({w}, '?')) AND {w} <> '{MATCH_ALL}') "
                f"OR {_count_sql(w, '(')} <> {_count_sql(w, ')')} "
                f"OR {_count_sql(w, '[')} + {_count_sql(w, '{')} <> {_count_sql(w, ']')} + {_count_sql(w, '}')} "
                f"OR {_count_sql(w, chr(34))} % 2 = 1)")
    return (f"(NOT ({qs} = '' OR starts_with({qs}, ' ') OR contains({qs}, '  ') OR "
            f"list_bool_or(list_transform({java_split_space_sql(qs)}, lambda {w}: {bad_word}))))")
