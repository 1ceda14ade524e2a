"""Column expressions for text: token pattern, case/accents folding, Java-style
trim and split.

Every function returns a ``pyspark.sql.Column`` built from built-in
expressions only, so it stays inside whole-stage codegen.  For the oracle
tests the same literals are exposed as SQL snippets (``*_sql`` helpers) that
DuckDB runs.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Word pattern approximating Unicode word breaks: an ideograph or Hiragana sign
# is a token by itself, Katakana signs form runs, and so do the letters of all
# other scripts (with their combining marks; those of Thai, Lao, Khmer and
# Myanmar too, as the standard leaves them to dictionaries), joined by an
# apostrophe, dot, colon or middle dot; numbers joined by . , ; or an
# apostrophe; underscores.  It has no look-around, so Java regex (Spark) and
# RE2 (DuckDB) read it the same way but for the names of scripts.
ALONE = r"\p{Han}\p{Hiragana}"
KATAKANA = r"\p{Katakana}\x{30FC}\x{FF70}\x{FF9E}\x{FF9F}"
# Longer tokens are split after so many characters.
MAX_TOKEN_CHARS = 255
# Marks that follow their letter in decomposed text (the same class in Java and RE2).
COMBINING_MARKS = r"[\x{0300}-\x{036F}]"

# Folds that Unicode decomposition does not give but ASCII folding does
# (ligatures, letters with strokes, typographic apostrophes).
FOLD_SPECIALS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "þ": "th",
    "Þ": "TH", "ı": "i", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ŋ": "n",
    "Ŋ": "N", "ƒ": "f", "ĸ": "q", "‘": "'", "’": "'", "ŉ": "n",
    "ƀ": "b", "Ɓ": "B", "Ƃ": "B", "ƃ": "b", "Ɔ": "O", "Ƈ": "C", "ƈ": "c", "Ɖ": "D", "Ɗ": "D", "Ƌ": "D", "ƌ": "d",
    "Ǝ": "E", "Ə": "A", "Ɛ": "E", "Ƒ": "F", "Ɠ": "G", "Ɩ": "I", "Ɨ": "I", "Ƙ": "K", "ƙ": "k", "ƚ": "l", "Ɯ": "M",
    "Ɲ": "N", "ƞ": "n", "Ɵ": "O", "Ƥ": "P", "ƥ": "p", "ƫ": "t", "Ƭ": "T", "ƭ": "t", "Ʈ": "T", "Ʋ": "V", "Ƴ": "Y",
    "ƴ": "y", "Ƶ": "Z", "ƶ": "z", "ǝ": "e", "Ǥ": "G", "ǥ": "g", "Ȥ": "Z", "ȥ": "z", "ȡ": "d", "ȴ": "l", "ȵ": "n",
    "ȶ": "t", "ȷ": "j", "Ⱥ": "A", "Ȼ": "C", "ȼ": "c", "Ƚ": "L", "Ⱦ": "T", "ȿ": "s", "ɀ": "z", "Ƀ": "B", "Ʉ": "U",
    "Ʌ": "V", "Ɇ": "E", "ɇ": "e", "Ɉ": "J", "ɉ": "j", "Ɋ": "Q", "ɋ": "q", "Ɍ": "R", "ɍ": "r", "Ɏ": "Y", "ɏ": "y",
    "ɐ": "a", "ɓ": "b", "ɕ": "c", "ɖ": "d", "ɗ": "d", "ɘ": "e", "ə": "a", "ɛ": "e", "ɟ": "j", "ɠ": "g", "ɡ": "g",
    "ɢ": "G", "ɥ": "h", "ɦ": "h", "ɨ": "i", "ɪ": "I", "ɫ": "l", "ɬ": "l", "ɭ": "l", "ɯ": "m", "ɱ": "m", "ɲ": "n",
    "ɳ": "n", "ɴ": "N", "ɵ": "o", "ɼ": "r", "ɽ": "r", "ɾ": "r", "ʂ": "s", "ʈ": "t", "ʉ": "u", "ʋ": "v", "ʌ": "v",
    "ʏ": "Y", "ʐ": "z", "ʑ": "z", "ⱡ": "l", "Ⱡ": "L", "Ɫ": "L", "Ᵽ": "P", "Ɽ": "R", "ⱥ": "a", "ⱦ": "t",
}
# Number of context words kept on each side of a highlighted term.
CONTEXT_WORDS = 2
# Hits returned per query.
MAX_HITS = 10
# ---------------------------------------------------------------------------


def _token_pattern(loop: str, alone: str, katakana: str, letter: str) -> str:
    """The pattern with its loops as given: Java runs possessive ones without
    recursion however long the word is (nothing follows a loop that it could
    give back)."""
    alone, katakana, letter = (rf"{c}\p{{M}}*{loop}" for c in (alone, katakana, letter))
    number = r"\p{N}"
    return (rf"{alone}|_*{loop}{katakana}(?:{katakana}|_)*{loop}"
            rf"|(?:{letter}(?:['’.:·]{letter})*{loop}|{number}(?:[.,;'’]{number})*{loop}|_)+{loop}")


TOKEN_PATTERN = _token_pattern("", f"[{ALONE}]", f"[{KATAKANA}]", rf"[^\P{{L}}{ALONE}{KATAKANA}]")
# The same for Java: its names of scripts, plain letters and low signs decided before scripts are looked up.
_ALONE, _KATAKANA = (c.replace(r"\p{", r"\p{Is") for c in (ALONE, KATAKANA))
SPARK_TOKEN_PATTERN = _token_pattern("+", rf"[\x{{2E80}}-\x{{10FFFF}}&&[{_ALONE}]]", rf"[\x{{30A0}}-\x{{10FFFF}}&&[{_KATAKANA}]]",
                                     rf"[a-zA-Z[\p{{L}}&&[^{_ALONE}{_KATAKANA}]]]")

# Unicode blocks whose letters, digits and symbols fold to ASCII by rule.
_FOLD_BLOCKS = [
    (0x00A0, 0x00FF),  # Latin-1 supplement
    (0x0100, 0x024F),  # Latin extended A and B
    (0x1E00, 0x1EFF),  # Latin extended additional
    (0x2070, 0x209F),  # super- and subscripts
    (0x1D00, 0x1DBF),  # phonetic extensions (modifier letters)
    (0x2460, 0x24FF),  # enclosed alphanumerics
    (0x2C60, 0x2C7F),  # Latin extended C
    (0xA720, 0xA7FF),  # Latin extended D
    (0xFB00, 0xFB06),  # Latin ligatures
    (0xFF01, 0xFF5E),  # full-width ASCII
]


def _strip_marks(s: str, form: str) -> str:
    return "".join(c for c in unicodedata.normalize(form, s) if not unicodedata.combining(c))


@lru_cache(maxsize=None)
def fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(from, to, multi) for ASCII folding, derived by rule.

    A character maps to its compatibility decomposition without combining
    marks when that is plain ASCII; one-to-one maps go to ``translate``,
    longer ones to ``replace``.  ``FOLD_SPECIALS`` adds the rest.
    """
    one: dict[str, str] = {}
    multi: dict[str, str] = {}
    for lo, hi in _FOLD_BLOCKS:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            base = _strip_marks(ch, "NFKD")
            if base and base != ch and base.isascii() and base.isprintable() and base.strip():
                (one if len(base) == 1 else multi)[ch] = base
    for ch, base in FOLD_SPECIALS.items():
        one.pop(ch, None)
        multi.pop(ch, None)
        (one if len(base) == 1 else multi)[ch] = base
    src = "".join(one)
    dst = "".join(one[c] for c in src)
    return src, dst, tuple(sorted(multi.items()))


@lru_cache(maxsize=None)
def strip_accent_tables() -> tuple[str, str]:
    """(from, to) for accent stripping: canonical decomposition minus marks."""
    src, dst = [], []
    for lo, hi in _FOLD_BLOCKS[:3]:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            base = _strip_marks(ch, "NFD")
            if len(base) == 1 and base != ch:
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


def _is_ascii(c: Column) -> Column:
    # byte length equals character length only for pure ASCII strings
    return F.octet_length(c) == F.length(c)


def ascii_fold(c: Column) -> Column:
    """ASCII folding of a string column (diacritics, ligatures, full-width).

    Signs that fold to one go through ``translate``; only a text that then
    still has others is taken apart and looked up sign by sign."""
    src, dst, multi = fold_tables()
    # constants, folded by the optimizer
    signs, bases = F.split(F.lit(" ".join(ch for ch, _ in multi)), " "), F.split(F.lit(" ".join(base for _, base in multi)), " ")

    def one(ch: Column) -> Column:
        place = F.array_position(signs, ch).cast("int")
        return F.when(place > 0, F.get(bases, place - 1)).otherwise(ch)

    plain = F.translate(c, src, dst)
    apart = F.transform(F.split(plain, ""), lambda ch: F.when(_is_ascii(ch), ch).otherwise(one(ch)))
    return F.when(_is_ascii(c), c).when(_is_ascii(plain), plain).otherwise(F.array_join(apart, ""))


def strip_accents(c: Column) -> Column:
    """Remove diacritics that decompose canonically (used for stop words),
    whether a letter comes with its mark or before it."""
    src, dst = strip_accent_tables()
    return F.regexp_replace(F.translate(c, src, dst), COMBINING_MARKS, "")


def normalize_term(token: Column) -> Column:
    """lower-case then fold: the filter chain applied to every token."""
    return ascii_fold(F.lower(token))


def split_long(token: Column) -> Column:
    """A token in parts of at most MAX_TOKEN_CHARS characters."""
    parts = F.sequence(F.lit(0), F.floor((F.length(token) - 1) / MAX_TOKEN_CHARS).cast("int"))
    cut = F.transform(parts, lambda k: F.substring(token, k * MAX_TOKEN_CHARS + 1, F.lit(MAX_TOKEN_CHARS)))
    return F.when(F.length(token) <= MAX_TOKEN_CHARS, F.array(token)).otherwise(cut)


def token_array(text: Column) -> Column:
    """All word tokens of a text, in order (no offsets)."""
    found = F.transform(F.array(F.regexp_extract_all(text, F.lit(SPARK_TOKEN_PATTERN), 0)), lambda ts: F.when(
        F.exists(ts, lambda t: F.length(t) > MAX_TOKEN_CHARS), F.flatten(F.transform(ts, split_long))).otherwise(ts))
    return found[0]


def java_trim(c: Column) -> Column:
    """String.trim(): strip characters <= U+0020 at both ends."""
    return F.btrim(c, F.lit("".join(map(chr, range(0x21)))))


def java_split_space(c: Column) -> Column:
    """String.split(" "): keeps leading and inner empty strings, drops trailing
    ones; "" gives [""] and an all-space string gives []."""
    stripped = F.regexp_replace(c, " +$", "")
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, " "))
    )


# --- SQL text for the DuckDB oracle -------------------------------------------

def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ascii_fold_sql(expr: str) -> str:
    src, dst, multi = fold_tables()
    out = f"translate({expr}, {sql_str(src)}, {sql_str(dst)})"
    for ch, base in multi:
        out = f"replace({out}, {sql_str(ch)}, {sql_str(base)})"
    return out


def strip_accents_sql(expr: str) -> str:
    src, dst = strip_accent_tables()
    return f"regexp_replace(translate({expr}, {sql_str(src)}, {sql_str(dst)}), '{COMBINING_MARKS}', '', 'g')"


def token_array_sql(expr: str) -> str:
    n = MAX_TOKEN_CHARS
    parts = f"list_transform(range(0, greatest(1, CAST(ceil(length(t) / {n}) AS BIGINT))), lambda k: substring(t, CAST(k * {n} + 1 AS BIGINT), {n}))"
    return f"flatten(list_transform(regexp_extract_all({expr}, {sql_str(TOKEN_PATTERN)}), lambda t: {parts}))"


def normalize_term_sql(expr: str) -> str:
    return f"(CASE WHEN strlen({expr}) = length({expr}) THEN lower({expr}) ELSE {ascii_fold_sql(f'lower({expr})')} END)"


def java_split_space_sql(expr: str) -> str:
    stripped = f"regexp_replace({expr}, ' +$', '')"
    return (f"(CASE WHEN {expr} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE string_split({stripped}, ' ') END)")
