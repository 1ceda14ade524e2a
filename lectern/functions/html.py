"""Visible text of HTML as column expressions.

What counts as markup follows the HTML rule: ``<`` opens a tag before a
letter, ``/``, ``!`` or ``?`` only, quotes in a tag count after ``=``, and a
comment, hidden element or tag that is never closed reaches to the end.
Character references are those of the HTML standard, as Python's own table
(``html.entities.html5``) lists them; numeric ones follow its rules for signs
that are not allowed.
"""

from __future__ import annotations

from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Elements whose content is not visible text.
HIDDEN_ELEMENTS = ["script", "style", "noscript", "template"]
# White space collapsed to one space, the no-break space too (the same class in Java and RE2).
WHITESPACE_RUN = r"[\t\n\f\r \x{00A0}]+"
# A character reference: decimal, hexadecimal or by name, the semicolon optional.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)"
# ---------------------------------------------------------------------------

GAP = r"[\t\n\f\r ]"


def strip_patterns(possessive: bool) -> list[str]:
    """Regexes removed in order: comments, hidden elements with their content, any other tag.

    Java runs possessive loops without recursion; RE2 has none and needs none."""
    loop = "*+" if possessive else "*"
    pats = [r"(?s)<!--.*?(?:-->|\z)"]
    inside = rf"(?:={GAP}*\"[^\"]*\"|={GAP}*'[^']*'|[^>]){loop}"
    pats += [rf"(?is)<{tag}(?:{GAP[:-1]}/]{inside})?>.*?(?:</{tag}(?:{GAP[:-1]}/][^>]*)?>|\z)" for tag in HIDDEN_ELEMENTS]
    pats.append(rf"(?s)<(?:[A-Za-z]|/[A-Za-z]){inside}(?:>|\z)")
    pats.append(r"(?s)<(?:[!?]|/[^A-Za-z])[^>]*(?:>|\z)")  # declarations and the like
    return pats


def replaced_code(n: int) -> str:
    """What a numeric reference to a sign that is not allowed stands for."""
    if 0x80 <= n <= 0x9F:  # read as Windows-1252
        try:
            return bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            return chr(n)
    if n == 0 or 0xD800 <= n <= 0xDFFF or n > 0x10FFFF:
        return "�"
    control = n < 0x20 and n not in (0x09, 0x0A, 0x0C, 0x0D) or n == 0x7F
    return "" if control or 0xFDD0 <= n <= 0xFDEF or n & 0xFFFE == 0xFFFE else chr(n)


@lru_cache(maxsize=1)
def names() -> dict[str, str]:
    """Reference names (with their semicolon, where they need it) and their signs."""
    return dict(html5)


@lru_cache(maxsize=1)
def without_semicolon() -> str:
    """Pattern of the names that need no semicolon, longer ones first."""
    return "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


@lru_cache(maxsize=1)
def odd_codes() -> dict[int, str]:
    """Single codes that don't stand for themselves (ranges are written out in the expressions)."""
    low = {n: replaced_code(n) for n in range(0xA0) if replaced_code(n) != chr(n)}
    return low


def _constant_map(pairs: dict[str, str]) -> Column:
    return F.map_from_arrays(F.split(F.lit(" ".join(pairs)), " "), F.split(F.lit("\x1e".join(pairs.values())), "\x1e"))


def _code(digits: Column, base: int) -> Column:
    """The sign of a numeric reference's digits; numbers too long for a sign are too large."""
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    n = F.when(F.length(short) > 8, F.lit(0x110000)).otherwise(F.conv(short, base, 10).cast("long"))
    sign = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    odd = {str(k): v for k, v in odd_codes().items()}
    return F.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "�").when(
        n < 0xA0, F.coalesce(F.try_element_at(_constant_map(odd), n.cast("string")), sign)).when(
        n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), "").otherwise(sign)


def decoded_reference(ref: Column) -> Column:
    """The sign or signs of one reference (``&`` first); an unknown name stays as it is."""
    body = F.substring(ref, 2, 40)
    digits = F.regexp_extract(ref, "^&#([0-9]+)", 1)
    hexes = F.regexp_extract(ref, "^&#[xX]([0-9a-fA-F]+)", 1)
    old = F.regexp_extract(body, f"^({without_semicolon()})", 1)
    table = _constant_map(names())
    part = F.concat(F.try_element_at(table, old), F.substring(body, F.length(old) + 1, F.length(body)))
    return F.when(digits != "", _code(digits, 10)).when(hexes != "", _code(hexes, 16)).otherwise(
        F.coalesce(F.try_element_at(table, body), F.when(old != "", part), ref))


def unescaped(text: Column) -> Column:
    """Every character reference of a text replaced, each once."""
    refs = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), 0), decoded_reference)
    pieces = F.split(text, REFERENCE, -1)
    both = F.zip_with(pieces, refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit(""))))
    return F.when(F.instr(text, "&") == 0, text).otherwise(F.array_join(both, ""))


def html_to_text(html: Column) -> Column:
    """Visible text: comments, hidden elements and tags count as a blank,
    references are replaced, white space collapses to one blank."""
    t = F.coalesce(html, F.lit(""))
    for pattern in strip_patterns(True):
        t = F.regexp_replace(t, pattern, " ")
    return F.trim(F.regexp_replace(unescaped(t), WHITESPACE_RUN, " "))


# UTF-16 in hexadecimal, either order of bytes: units outside the surrogates, or a high and a low one.
_ANY, _UNIT, _HIGH, _LOW = "[0-9A-F]{2}", "(?:[0-9A-CEF][0-9A-F]|D[0-7])", "D[89AB]", "D[C-F]"
UTF16_BE = f"^(?:{_UNIT}{_ANY}|{_HIGH}{_ANY}{_LOW}{_ANY})*+$"
UTF16_LE = f"^(?:{_ANY}{_UNIT}|{_ANY}{_HIGH}{_ANY}{_LOW})*+$"


def decoded_bytes(content: Column) -> Column:
    """Text of a file's bytes: by its byte-order mark, as UTF-8, or as Latin-1
    where the first 1024 bytes declare it; null where none of these fits."""
    start = F.hex(F.substring(content, 1, 3))
    text = content.cast("string")
    declared = F.decode(F.substring(content, 1, 1024), "ISO-8859-1").rlike(r"(?i)(?:charset|encoding)\s*=\s*[\"']?\s*(?:iso-8859-1|latin-?1|windows-1252|us-ascii)")
    return F.when(start == "EFBBBF", F.substring(content, F.lit(4), F.greatest(F.octet_length(content) - 3, F.lit(0))).cast("string")).when(
        start.startswith("FEFF") & F.hex(content).rlike(UTF16_BE) | start.startswith("FFFE") & F.hex(content).rlike(UTF16_LE), F.decode(content, "UTF-16")).when(
        F.is_valid_utf8(text), text).when(declared, F.decode(content, "ISO-8859-1"))


# --- SQL text for the DuckDB oracle -------------------------------------------

def html_to_text_sql(expr: str) -> str:
    """The same in DuckDB: references cut out, looked up one by one and put back."""
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    t = f"coalesce({expr}, '')"
    for pat in strip_patterns(False):
        t = f"regexp_replace({t}, {lit(pat)}, ' ', 'g')"
    table = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in names().items()) + "}"
    odd = "MAP {" + ", ".join(f"{k}: {lit(v) if v else lit('')}" for k, v in odd_codes().items() if v != "\x00") + "}"
    code = (f"CASE WHEN n > 1114111 OR n BETWEEN 55296 AND 57343 THEN chr(65533) WHEN n < 160 THEN coalesce({odd}[n], chr(CAST(n AS INTEGER))) "
            "WHEN n BETWEEN 64976 AND 65007 OR n & 65534 = 65534 THEN '' ELSE chr(CAST(n AS INTEGER)) END")
    number = lambda digits: f"list_transform([CASE WHEN length(ltrim({digits}, '0')) > 8 THEN 1114112 ELSE %s END], lambda n: {code})[1]"
    dec = number("regexp_extract(r, '^&#([0-9]+)', 1)") % "CAST('0' || ltrim(regexp_extract(r, '^&#([0-9]+)', 1), '0') AS BIGINT)"
    hexa = number("regexp_extract(r, '^&#[xX]([0-9a-fA-F]+)', 1)") % "CAST('0x0' || ltrim(regexp_extract(r, '^&#[xX]([0-9a-fA-F]+)', 1), '0') AS BIGINT)"
    old = f"regexp_extract(r[2:], '^({without_semicolon()})', 1)"
    one = (f"CASE WHEN regexp_matches(r, '^&#[0-9]') THEN {dec} WHEN regexp_matches(r, '^&#[xX]') THEN {hexa} "
           f"ELSE coalesce({table}[r[2:]], CASE WHEN {old} <> '' THEN {table}[{old}] || r[2 + length({old}):] END, r) END")
    pieces = f"regexp_split_to_array(t, {lit(REFERENCE)})"
    refs = f"list_transform(regexp_extract_all(t, {lit(REFERENCE)}), lambda r: {one})"
    joined = f"list_transform([{t}], lambda t: array_to_string(list_transform(list_zip({pieces}, {refs}), lambda z: z[1] || coalesce(z[2], '')), ''))[1]"
    return f"trim(regexp_replace({joined}, {lit(WHITESPACE_RUN)}, ' ', 'g'))"
