"""Romanian suffix stemming of folded terms, as column expressions.

The published suffix rules, as far as they can apply to ASCII letters: the
regions R1, R2 and RV are places in the word, and each step looks at the
longest listed suffix only.  One rule table makes the Spark expression and the
SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The suffix rules by step, as (suffixes, what stands for them).
CASE_ENDINGS = [
    ("ul ului", ""), ("aua", "a"), ("ea ele elor", "e"), ("ii iua iei iile iilor ilor", "i"), ("ile", "i"), ("atei", "at"),
]
COMBINED = [
    ("abilitate abilitati", "abil"), ("ibilitate", "ibil"), ("ivitate ivitati", "iv"),
    ("icitate icitati icator icatori iciv iciva icive icivi ical icala icale icali", "ic"),
    ("ativ ativa ative ativi atoare ator atori", "at"), ("itiv itiva itive itivi itoare itor itori", "it"),
]
STANDARD = [
    ("at ata ati ate ut uta uti ute it ita iti ite ic ica ice ici abil abila abile abili ibil ibila ibile ibili oasa oase os osi "
     "ant anta ante anti ator atori itate itati iv iva ive ivi", ""),
    ("ism isme ist ista iste isti", "ist"),
]
VERB_AFTER_CONSONANT = ("are ere ire ind indu eze ez ezi esc am ai au eam eai ea eau iam iai ia iau ui asem ase isem ise usem use")
VERB_ALWAYS = "em im sei se sesem sese"
FINAL_VOWELS = "a e i ie"
# Vowels; i and u between vowels count as consonants and are written I and U.
VOWELS = "aeiou"
# ---------------------------------------------------------------------------

V, C = f"[{VOWELS}]", f"[^{VOWELS}]"
REGION = f"^{C}*{V}+{C}(.*)$"
RV_CASES = [(f"^.{C}", f"^.{C}+{V}(.*)$"), (f"^{V}{V}", f"^{V}+{C}(.*)$"), ("", f"^{C}{V}.(.*)$")]


def _rules(table: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(suffix, replacement), the longest suffix first."""
    return sorted(((s, r) for suffixes, r in table for s in suffixes.split()), key=lambda x: (-len(x[0]), x[0]))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _replaced(w: Column, s: str, r: str) -> Column:
    return F.concat(F.substring(w, F.lit(1), F.length(w) - len(s)), F.lit(r))


def _place(w: Column, pattern: str) -> Column:
    """How many letters stand before the region that a pattern's group holds."""
    return F.length(w) - F.length(F.regexp_extract(w, pattern, 1))


def _step(w: Column, rules: list[tuple[str, str]], place: Column) -> Column:
    """The word with its longest listed suffix replaced, if that lies at or after ``place``."""
    out = None
    for s, r in rules:
        held = F.length(w) - len(s) >= place
        if s == "ile":
            held = held & ~w.endswith("abile")
        done = F.when(held, _replaced(w, s, r)).otherwise(w)
        out = F.when(w.endswith(s), done) if out is None else out.when(w.endswith(s), done)
    return out.otherwise(w)


def _verb_step(w: Column, place: Column) -> Column:
    out = None
    always = set(VERB_ALWAYS.split())
    for s, _ in _rules([(VERB_AFTER_CONSONANT, ""), (VERB_ALWAYS, "")]):
        found = w.endswith(s) & (F.length(w) - len(s) >= place)
        before = F.substring(w, F.length(w) - len(s), F.lit(1))
        free = F.lit(True) if s in always else (F.length(w) - len(s) > place) & ~before.isin("a", "e", "i", "o")
        done = F.when(free, _replaced(w, s, "")).otherwise(w)
        out = F.when(found, done) if out is None else out.when(found, done)
    return out.otherwise(w)


def romanian_stem(term: Column) -> Column:
    """The stem of a folded, lower-case term."""
    marked = F.regexp_replace(F.regexp_replace(term, f"({V})i({V})", "$1I$2"), f"({V})u({V})", "$1U$2")

    def with_places(w: Column) -> Column:
        r1 = F.regexp_extract(w, REGION, 1)
        rv = F.when(w.rlike(RV_CASES[0][0]), _place(w, RV_CASES[0][1])).when(w.rlike(RV_CASES[1][0]), _place(w, RV_CASES[1][1])).otherwise(_place(w, RV_CASES[2][1]))
        return F.struct(w.alias("w"), _place(w, REGION).alias("p1"), (F.length(w) - F.length(F.regexp_extract(r1, REGION, 1))).alias("p2"), rv.alias("pv"))

    def run(x: Column) -> Column:
        combined = _rules(COMBINED)
        steps = [lambda w: _step(w, combined, x["p1"])] * 3 + [lambda w: _step(w, _rules(STANDARD), x["p2"])]

        def verbs(start: Column, end: Column) -> Column:
            left = F.when(start == end, _verb_step(end, x["pv"])).otherwise(end)
            return _let(left, lambda w: _step(w, _rules([(FINAL_VOWELS, "")]), x["pv"]))

        def chain(start: Column, w: Column, rest: list) -> Column:
            return _let(rest[0](w), lambda n: chain(start, n, rest[1:])) if rest else verbs(start, w)

        return _let(_step(x["w"], _rules(CASE_ENDINGS), x["p1"]), lambda w: chain(w, w, steps))

    stem = _let(_let(marked, with_places), run)
    return F.translate(stem, "IU", "iu")


# --- SQL text for the DuckDB oracle -------------------------------------------

def _step_sql(w: str, rules: list[tuple[str, str]], place: str) -> str:
    out = []
    for s, r in rules:
        held = f"length({w}) - {len(s)} >= {place}" + (f" AND NOT ends_with({w}, 'abile')" if s == "ile" else "")
        out.append(f"WHEN ends_with({w}, '{s}') THEN CASE WHEN {held} THEN left({w}, length({w}) - {len(s)}) || '{r}' ELSE {w} END")
    return f"CASE {' '.join(out)} ELSE {w} END"


def _verb_sql(w: str, place: str) -> str:
    out, always = [], set(VERB_ALWAYS.split())
    for s, _ in _rules([(VERB_AFTER_CONSONANT, ""), (VERB_ALWAYS, "")]):
        free = "true" if s in always else f"length({w}) - {len(s)} > {place} AND substring({w}, length({w}) - {len(s)}, 1) NOT IN ('a', 'e', 'i', 'o')"
        out.append(f"WHEN ends_with({w}, '{s}') AND length({w}) - {len(s)} >= {place} THEN CASE WHEN {free} THEN left({w}, length({w}) - {len(s)}) ELSE {w} END")
    return f"CASE {' '.join(out)} ELSE {w} END"


def stem_ctes(source: str, name: str) -> str:
    """CTEs from ``source(term)`` to ``name(term, stem)``."""
    place = lambda w, pattern: f"length({w}) - length(regexp_extract({w}, '{pattern}', 1))"
    rv = (f"CASE WHEN regexp_matches(w, '{RV_CASES[0][0]}') THEN {place('w', RV_CASES[0][1])} "
          f"WHEN regexp_matches(w, '{RV_CASES[1][0]}') THEN {place('w', RV_CASES[1][1])} ELSE {place('w', RV_CASES[2][1])} END")
    combined = _rules(COMBINED)
    return f"""
{name}_m AS (SELECT term, regexp_replace(regexp_replace(term, '({V})i({V})', '\\1I\\2', 'g'), '({V})u({V})', '\\1U\\2', 'g') AS w FROM {source}),
{name}_p AS (SELECT term, w, {place('w', REGION)} AS p1, length(w) - length(regexp_extract(regexp_extract(w, '{REGION}', 1), '{REGION}', 1)) AS p2, {rv} AS pv FROM {name}_m),
{name}_0 AS (SELECT * REPLACE ({_step_sql('w', _rules(CASE_ENDINGS), 'p1')} AS w) FROM {name}_p),
{name}_1 AS (SELECT *, {_step_sql('w', combined, 'p1')} AS x FROM {name}_0),
{name}_2 AS (SELECT * REPLACE ({_step_sql('x', combined, 'p1')} AS x) FROM {name}_1),
{name}_3 AS (SELECT * REPLACE ({_step_sql('x', combined, 'p1')} AS x) FROM {name}_2),
{name}_4 AS (SELECT * REPLACE ({_step_sql('x', _rules(STANDARD), 'p2')} AS x) FROM {name}_3),
{name}_5 AS (SELECT * REPLACE (CASE WHEN x = w THEN {_verb_sql('x', 'pv')} ELSE x END AS x) FROM {name}_4),
{name} AS (SELECT term, translate({_step_sql('x', _rules([(FINAL_VOWELS, "")]), 'pv')}, 'IU', 'iu') AS stem FROM {name}_5)"""
