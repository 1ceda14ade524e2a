"""Query matching: free-text queries and clause tables against the index.

Queries come as a batch.  A free-text query ``(query_id, query)`` becomes
``should``/``term`` clauses (default OR).  Everything else (AND / NOT,
boosts, prefix, wildcard, fuzzy, regexp, term ranges, field terms, match
all) comes as a clause table::

    clauses(query_id, clause_no, occur, field, kind, term, term2, boost)
      occur in {should, must, must_not}
      field in {content, fileName, path}
      kind  in {term, exact, prefix, wildcard, fuzzy, regexp, range,
                range_exclusive, all}
      term2: upper bound for ranges, maximum edits (up to 2) for fuzzy

``exact`` is a content term as it is stored; on the names every ``term`` is.
An unknown occur, field or kind is an error.

A clause table of up to ``lookup.LIMIT`` rows is taken once while the query is
planned; its terms then become filters on the folders and pages of a stored
index.  Larger batches, and an index that isn't stored, are met by joins
without hints.  Multi-term kinds are expanded first: prefixes and ranges
through bounds on the sorted vocabulary, wildcards and regular expressions
through trigrams, fuzzy terms through deletions; patterns without a trigram
and all patterns on names are tried on the whole vocabulary.
"""

from __future__ import annotations

from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.querysyntax import query_is_valid
from ..functions.scoring import bm25, bm25_idf, quantized_length
from ..functions.text import java_split_space, token_array
from .analysis import Analyzer, analyze_tokens
from .index import Index, names_of
from .lookup import IN_A_SET, bounded, column, dealt_by_rows, deletion_keys, either, needed_trigrams, settled, written

CLAUSE_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("clause_no", T.LongType()),
    T.StructField("occur", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("term", T.StringType()),
    T.StructField("term2", T.StringType()),
    T.StructField("boost", T.DoubleType()),
])

# --- fixed values -----------------------------------------------------------
# Default maximum edits of a fuzzy clause, and the most there can be.
FUZZY_DEFAULT_EDITS = 2
FUZZY_MAX_EDITS = 2
# ---------------------------------------------------------------------------

SORTED_KINDS = ["prefix", "range", "range_exclusive"]
PATTERN_KINDS = ["wildcard", "regexp"]
TERM_KINDS = ["term", "exact"]
KINDS = [*TERM_KINDS, "fuzzy", "all", *SORTED_KINDS, *PATTERN_KINDS]
FIELDS = ["content", "fileName", "path"]
OCCURS = ["should", "must", "must_not"]
OWN = ["query_id", "clause_no", "occur", "kind", "boost"]
MATCHED = [*OWN, "doc_id", "score"]
RESOLVED = [*OWN, "term", "df", "sim"]


def checked(clauses: DataFrame) -> DataFrame:
    """The clause table; a row with an unknown occur, field or kind raises an error."""
    known = F.col("kind").isin(KINDS) & F.col("field").isin(FIELDS) & F.col("occur").isin(OCCURS)
    message = F.concat(F.lit("unknown clause: "), F.to_json(F.struct("occur", "field", "kind")))
    kind = F.when(F.coalesce(known, F.lit(False)), F.col("kind")).otherwise(F.raise_error(message))
    return clauses.withColumn("kind", kind).withColumn("clause_no", F.col("clause_no").cast("long"))


# --- free text -----------------------------------------------------------------

def query_words(queries: DataFrame) -> DataFrame:
    """(query_id, word_no, word): lower-cased query split on single spaces."""
    return queries.select("query_id", F.posexplode(java_split_space(F.lower("query"))).alias("word_no", "word"))


def query_status(queries: DataFrame) -> DataFrame:
    """(query_id, query, valid)."""
    return queries.select("query_id", "query", query_is_valid(F.col("query")).alias("valid"))


def free_text_clauses(queries: DataFrame, analyzer: Analyzer) -> DataFrame:
    """Valid free-text queries -> should/term clause rows of analysed terms.

    A repeated term gives two clauses (it counts twice in the score)."""
    valid = queries.where(query_is_valid(F.col("query")))
    words = valid.select("query_id", F.posexplode(java_split_space(F.col("query"))).alias("word_no", "word"))
    toks = words.select("query_id", "word_no", F.posexplode(token_array(F.col("word"))).alias("token_no", "token"))
    terms = analyze_tokens(toks, analyzer)
    return terms.select(
        F.col("query_id").cast("long").alias("query_id"),
        (F.shiftleft(F.col("word_no").cast("long"), 32) + F.col("token_no")).alias("clause_no"),
        F.lit("should").alias("occur"), F.lit("content").alias("field"), F.lit("term").alias("kind"),
        F.col("term"), F.lit(None).cast("string").alias("term2"), F.lit(1.0).alias("boost"))


def word_terms(queries: DataFrame, analyzer: Analyzer) -> DataFrame:
    """(query_id, word_no, word, term): every lower-cased word with the terms
    it analyses to (none for a stop word)."""
    words = query_words(queries)
    toks = words.select("query_id", "word_no", "word",
                        F.posexplode(token_array(F.col("word"))).alias("token_no", "token"))
    return analyze_tokens(toks, analyzer).select("query_id", "word_no", "word", "term")


# --- clause expansion ------------------------------------------------------------

def _score_postings(expanded: DataFrame, index: Index, quantized: bool, narrow: Column | None = None, matches: int | None = None) -> DataFrame:
    """expanded(query_id, clause_no, occur, kind, term, boost, df, sim) x postings
    -> (query_id, clause_no, occur, kind, term, doc_id, tf, dl, score); see :meth:`Index.lookup`."""
    hits = index.with_totals(index.lookup(expanded, narrow, matches))
    dl = quantized_length(F.col("dl")) if quantized else F.col("dl")
    score = bm25(F.col("tf"), dl, F.col("df"), F.col("n_docs"), F.col("avgdl"), F.col("boost") * F.col("sim"))
    return hits.select("query_id", "clause_no", "occur", "kind", "term", "boost", "doc_id", "tf", "dl",
                       score.alias("score"))


def _rows_of(rows: pa.Table) -> int:
    """How many postings the terms of settled rows have, from their ``df``."""
    return sum(df or 0 for df in rows.column("df").to_pylist())


def _resolved(clause_terms: DataFrame, index: Index) -> tuple[DataFrame, int | None]:
    """Term clauses with the ``df`` of their terms, and how many postings they meet (None: the index isn't stored)."""
    found = index.resolve(clause_terms.select(*OWN, "term", F.lit(1.0).alias("sim"))).select(*RESOLVED)
    if not index.store:
        return found, None
    found, rows = settled(found)
    return found, _rows_of(rows) if rows is not None else found.agg(F.sum("df")).first()[0]


def term_matches(clause_terms: DataFrame, index: Index, quantized: bool = False) -> DataFrame:
    """Term clauses joined to the postings (any-term match), with BM25 per row."""
    return _score_postings(_resolved(clause_terms, index)[0], index, quantized)


def document_matches(clause_terms: DataFrame, index: Index, quantized: bool = False) -> DataFrame:
    """As :func:`term_matches`, dealt by document, to as many tasks as the matches ask for."""
    found, matches = _resolved(clause_terms, index)
    return _score_postings(found, index, quantized, matches=matches)


def _like_pattern(c: Column) -> Column:
    escaped = F.regexp_replace(c, r"([%_\\])", r"\\$1")
    return F.translate(escaped, "*?", "%_")


def _swap(c: Column, i: Column) -> Column:
    """c with characters i and i+1 (1-based) exchanged."""
    return F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.lit(1)),
                    F.substring(c, i, F.lit(1)), F.substring(c, i + 2, F.lit(1 << 30)))


def _swaps(c: Column) -> Column:
    """The strings that one exchange of neighbours makes of c (none for a single letter)."""
    return F.when(F.length(c) >= 2, F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: _swap(c, i))).otherwise(
        F.array().cast("array<string>"))


def edit_distance(a: Column, b: Column) -> Column:
    """Edits (an exchange of neighbours is one) up to FUZZY_MAX_EDITS, else a larger number.

    Two edits are two Levenshtein edits, an exchange and another edit, or two
    exchanges: one on either side."""
    far = F.lit(FUZZY_MAX_EDITS + 1)
    known = lambda d: F.when(d < 0, far).otherwise(d)
    lev = known(F.levenshtein(a, b, FUZZY_MAX_EDITS))
    one_swap = F.array_min(F.transform(_swaps(a), lambda x: known(F.levenshtein(x, b, 1)) + 1))
    two_swaps = F.when((F.length(a) == F.length(b)) & F.arrays_overlap(_swaps(a), _swaps(b)), 2)
    return F.when(lev <= 1, lev).when(F.abs(F.length(a) - F.length(b)) <= 1, F.least(lev, one_swap, two_swaps)).otherwise(lev)


def _sorted_terms(clauses: DataFrame, rows, index: Index, field: str) -> DataFrame:
    """(v, df) that prefix and range clauses can take: read through bounds on the sorted vocabulary."""
    if rows is None or index.store is None:
        return _vocabulary(index, field)
    name = "term" if field == "content" else "name"
    bounds = either([bounded(F.col(name), r["kind"], r["term"], r["term2"]) for r in rows.to_pylist() if r["field"] == field and r["kind"] in SORTED_KINDS])
    if field == "content":
        return index.store.merged(index.store.table("ordered").where(bounds)).withColumnRenamed("term", "v")
    return _counted_names(index.names(field).where(bounds))


def _vocabulary(index: Index, field: str) -> DataFrame:
    """(v, df): the stored terms, or the names of a field."""
    if field == "content":
        return index.term_stats.select(F.col("term").alias("v"), "df")
    return _counted_names(index.names(field))


def _counted_names(names: DataFrame) -> DataFrame:
    return names.groupBy(F.col("name").alias("v")).agg(F.count(F.lit(1)).alias("df"))


def _expand_sorted(clauses: DataFrame, rows, index: Index, field: str) -> DataFrame:
    v, t, t2, kind = F.col("v"), F.col("term"), F.col("term2"), F.col("kind")
    cond = (
        ((kind == "prefix") & v.startswith(t))
        | ((kind == "range") & (t.isNull() | (v >= t)) & (t2.isNull() | (v <= t2)))
        | ((kind == "range_exclusive") & (t.isNull() | (v > t)) & (t2.isNull() | (v < t2)))
    )
    c = clauses.where((F.col("field") == field) & kind.isin(*SORTED_KINDS))
    return _sorted_terms(clauses, rows, index, field).join(c, cond).select(*OWN, "v", "df", F.lit(1.0).alias("sim"))


def _expand_patterns(clauses: DataFrame, rows, index: Index, field: str) -> DataFrame:
    """Wildcards and regular expressions: clauses with trigrams meet the terms
    that hold all of them, others the whole vocabulary."""
    v, kind = F.col("v"), F.col("kind")
    cond = ((kind == "wildcard") & F.like(v, _like_pattern(F.col("term")))) | ((kind == "regexp") & F.rlike(v, F.concat(F.lit("^(?:"), F.col("term"), F.lit(")$"))))
    c = clauses.where((F.col("field") == field) & kind.isin(*PATTERN_KINDS))
    every = lambda some: _vocabulary(index, field).join(some, cond).select(*OWN, "v", "df", F.lit(1.0).alias("sim"))
    if rows is None or index.store is None or field != "content":
        return every(c)
    mine = [r for r in rows.to_pylist() if r["field"] == field and r["kind"] in PATTERN_KINDS and r["term"] is not None]
    needed = {(r["query_id"], r["clause_no"]): needed_trigrams(r["kind"], r["term"]) for r in mine}
    known = [(q, n, g, len(grams)) for (q, n), grams in needed.items() for g in grams]
    keyed = F.struct("query_id", "clause_no").isin([F.struct(F.lit(q).cast("long"), F.lit(n).cast("long")) for (q, n), grams in needed.items() if grams])
    out = None
    if known:
        kinds = {"query_id": pa.int64(), "clause_no": pa.int64(), "gram": pa.string(), "n_grams": pa.int32()}
        wanted = clauses.sparkSession.createDataFrame(pa.table({name: pa.array([r[k] for r in known], kind) for k, (name, kind) in enumerate(kinds.items())}))
        held = index.store.rows("trigrams", sorted({r[2] for r in known})).groupBy("gram", "term").agg(F.sum("df").alias("df"))  # over the segments
        met = held.join(wanted, "gram").groupBy("query_id", "clause_no", F.col("term").alias("v"), "n_grams").agg(F.count(F.lit(1)).alias("n"), F.max("df").alias("df"))
        out = met.where("n = n_grams").join(c, ["query_id", "clause_no"]).where(cond).select(*OWN, "v", "df", F.lit(1.0).alias("sim"))
    if any(not grams for grams in needed.values()):
        rest = every(c.where(~keyed) if known else c)
        out = rest if out is None else out.unionByName(rest)
    return out if out is not None else every(c)


def _expand_fuzzy(clauses: DataFrame, rows, index: Index, field: str, max_expansions: int | None) -> DataFrame:
    """Fuzzy clauses: terms that share a deletion key with the clause's, then the distance."""
    v, t = F.col("v"), F.col("term")
    edits = F.least(F.greatest(F.coalesce(F.col("term2").try_cast("int"), F.lit(FUZZY_DEFAULT_EDITS)), F.lit(0)), F.lit(FUZZY_MAX_EDITS))
    c = clauses.where((F.col("field") == field) & (F.col("kind") == "fuzzy")).withColumn("edits", edits)
    if rows is None or index.store is None or field != "content":
        near = _vocabulary(index, field).join(c, F.abs(F.length("v") - F.length("term")) <= F.col("edits"))
    else:
        keyed, keys = settled(c.select("*", F.explode(deletion_keys(t)).alias("key")))
        if keys is None:  # very many clauses
            stored = index.store.table("deletions")
        else:
            stored = index.store.rows("deletions", column(keys, "key"))
        met = stored.select("key", F.col("term").alias("v"), "df").join(keyed, "key").where(F.abs(F.length("v") - F.length("term")) <= F.col("edits"))
        # a term once for each clause, whatever the keys they share; its df over the segments
        one = met.groupBy(*OWN, "term", "edits", "v", "key").agg(F.sum("df").alias("df"))
        near = one.groupBy(*OWN, "term", "edits", "v").agg(F.max("df").alias("df"))
    near = near.withColumn("dist", edit_distance(t, v)).where(F.col("dist") <= F.col("edits"))
    sim = F.lit(1.0) - F.col("dist") / F.least(F.length(t), F.length(v))
    near = near.select(*OWN, "v", "df", sim.alias("sim")).where("sim > 0")
    if max_expansions is not None:
        w = Window.partitionBy("query_id", "clause_no").orderBy(F.col("sim").desc(), F.col("v"))
        near = near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_expansions).drop("_r")
    return near


def expand_multiterm(clauses: DataFrame, index: Index, max_expansions: int | None = None) -> DataFrame | None:
    """Prefix, wildcard, regexp, range and fuzzy clauses -> the terms or names they stand for.

    (query_id, clause_no, occur, kind, boost, field, term, df, sim), or None if
    the clauses are known to have no such kind.  Patterns are applied to the
    stored terms as written (not analysed).  A fuzzy clause takes all terms
    within its edits and a similarity over 0, or the ``max_expansions`` most
    similar ones if a number is given.  Each field and group of kinds that
    occurs is expanded on its own."""
    clauses, rows = settled(clauses)
    out = None
    for field in FIELDS:
        for kinds, expand in ((SORTED_KINDS, _expand_sorted), (PATTERN_KINDS, _expand_patterns), (["fuzzy"], partial(_expand_fuzzy, max_expansions=max_expansions))):
            if rows is not None and not any(r["field"] == field and r["kind"] in kinds for r in rows.to_pylist()):
                continue
            part = expand(clauses, rows, index, field).select(*OWN, F.lit(field).alias("field"), F.col("v").alias("term"), "df", "sim")
            out = part if out is None else out.unionByName(part)
    return out


def _can_match(clauses: DataFrame) -> Column | None:
    """Which terms a small batch's multi-term clauses on the content can stand for, as a
    filter on a ``term`` column (None: not known, or a fuzzy clause is there)."""
    rows = settled(clauses)[1]
    mine = None if rows is None else [r for r in rows.to_pylist() if r["field"] == "content" and r["kind"] in ["fuzzy", *SORTED_KINDS, *PATTERN_KINDS]]
    if mine is None or len(mine) > IN_A_SET or any(r["kind"] == "fuzzy" for r in mine):
        return None
    term = F.col("term")
    one = {"wildcard": lambda r: F.like(term, _like_pattern(F.lit(r["term"]))), "regexp": lambda r: F.rlike(term, F.lit(f"^(?:{r['term']})$"))}
    return either([one[r["kind"]](r) if r["kind"] in one else bounded(term, r["kind"], r["term"], r["term2"])
                   for r in mine if r["kind"] not in [*PATTERN_KINDS, "prefix"] or r["term"] is not None])


def _scored(terms: DataFrame | None, clauses: DataFrame | None, index: Index, quantized: bool, max_expansions: int | None) -> tuple[DataFrame | None, int | None]:
    """(query_id, clause_no, occur, doc_id, score), each clause and document once, of the
    term clauses ``terms`` and the multi-term ones of ``clauses`` (None: there are none),
    and the number of matches it is made of (None: not known).

    Clauses on the content meet the postings together, dealt by document to as
    many tasks as the matches ask for; these sums, and those of all clauses
    after it, are made in place."""
    wanted, narrow, matches, named = [], F.lit(False), 0, []
    if terms is not None:
        found, matches = _resolved(terms, index)
        rows = getattr(found, "settled_rows", None)
        few = rows is not None and rows.num_rows <= IN_A_SET
        narrow = F.col("term").isin(column(rows, "term")) if few else None
        wanted.append(found)
    expanded = expand_multiterm(clauses, index, max_expansions) if clauses is not None else None
    if expanded is not None:
        expanded, rows = settled(expanded)
        if rows is None:  # made once, and counted
            expanded = written(expanded, "expansion")
        if matches is not None:
            matches += _rows_of(rows) if rows is not None else expanded.agg(F.sum("df")).first()[0]
        fields = column(rows, "field") if rows is not None else FIELDS
        if "content" in fields:
            wanted.append(expanded.where(F.col("field") == "content").select(*RESOLVED))
            possible = _can_match(clauses)
            narrow = None if narrow is None or possible is None else narrow | possible
        for field in set(fields) - {"content"}:
            own = expanded.where(F.col("field") == field).withColumnRenamed("term", "name")
            met = index.names(field).join(own if rows is None else F.broadcast(own), ["field", "name"])
            score = F.col("boost") * F.col("sim") * bm25_idf(F.col("num_docs"), F.col("df"))
            named.append(index.with_totals(met).withColumn("score", score).select(*MATCHED))
    named = [p if matches is None else dealt_by_rows(p, matches, "doc_id") for p in named]
    if wanted:
        content = _score_postings(reduce(DataFrame.unionByName, wanted), index, quantized, narrow, matches)
        named.append(content.select(*MATCHED))
    if not named:
        return None, matches
    out = reduce(DataFrame.unionByName, named).groupBy("query_id", "clause_no", "occur", "kind", "doc_id").agg(
        F.sum("score").alias("sum"), F.max("boost").alias("boost"))
    constant = F.col("kind").isin(*SORTED_KINDS, *PATTERN_KINDS)
    return out.select("query_id", "clause_no", "occur", "doc_id", F.when(constant, F.col("boost")).otherwise(F.col("sum")).alias("score")), matches


def multiterm_matches(clauses: DataFrame, index: Index, quantized: bool = False,
                      max_expansions: int | None = None) -> DataFrame | None:
    """(query_id, clause_no, occur, doc_id, score) of multi-term clauses:
    constant score (= boost) per document for pattern and range kinds, summed
    BM25 x similarity for fuzzy.  None if the clauses are known to have none."""
    return _scored(None, clauses, index, quantized, max_expansions)[0]


def field_matches(clauses: DataFrame, index: Index) -> DataFrame | None:
    """fileName:/path: term clauses: equality with the raw name; scored as a
    one-term field without length norms (idf x boost).  None if the clauses are
    known to have none."""
    mine = clauses.where((F.col("field") != "content") & F.col("kind").isin("term", "exact"))
    c, rows = settled(mine.select("query_id", "clause_no", "occur", "field", F.col("term").alias("name"), "boost"))
    if rows is not None and not rows.num_rows:
        return None
    names = index.store.rows("names", column(rows, "name")) if rows is not None and index.store else names_of(index.docs)
    hit = names.join(c, ["field", "name"])
    df = hit.groupBy("query_id", "clause_no").agg(F.count(F.lit(1)).alias("df"))
    scored = index.with_totals(hit.join(df, ["query_id", "clause_no"]))
    return scored.select("query_id", "clause_no", "occur", "doc_id",
                         (F.col("boost") * bm25_idf(F.col("num_docs"), F.col("df"))).alias("score"))


# --- boolean combination --------------------------------------------------------------

def effective_clauses(clauses: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, clause_no, occur) of the clauses that take part: a content
    term clause whose text analyses to nothing (a stop word) is dropped.
    ``terms`` comes from :func:`clause_terms`."""
    other = clauses.where(~F.col("kind").isin(*TERM_KINDS) | (F.col("field") != "content")).select(
        "query_id", "clause_no", "occur")
    return terms.select("query_id", "clause_no", "occur").unionByName(other).distinct()


def combine(clauses: DataFrame, matches: DataFrame) -> DataFrame:
    """Boolean logic over per-clause matches -> (query_id, doc_id, score).

    must: every must clause matches; must_not: no such clause matches;
    should: adds score, and is required (at least one) when there is no must.
    A purely negative query has no hits.  ``clauses`` are the effective ones;
    ``matches`` has a row for each clause and document at most."""
    req, _ = settled(clauses.groupBy("query_id").agg(F.count_if(F.col("occur") == "must").alias("n_must")))
    fits = held(F.col("must_hit"), F.col("should_hit"), F.col("excluded"))
    return clause_counts(matches).join(req, "query_id").where(fits).select("query_id", "doc_id", "score")


def clause_counts(matches: DataFrame) -> DataFrame:
    """(query_id, doc_id, score, must_hit, should_hit, excluded) of each document that some clause matches."""
    wanted = F.col("occur") != "must_not"
    return matches.groupBy("query_id", "doc_id").agg(
        F.sum(F.when(wanted, F.col("score"))).alias("score"),
        F.count_if(F.col("occur") == "must").alias("must_hit"),
        F.count_if(F.col("occur") == "should").alias("should_hit"),
        F.count_if(~wanted).alias("excluded"))


def held(must_hit: Column, should_hit: Column, excluded: Column) -> Column:
    """A document with these numbers of matching clauses is a hit of a query with ``n_must`` must clauses."""
    return (excluded == 0) & (must_hit == F.col("n_must")) & ((F.col("n_must") > 0) | (should_hit > 0))


def match_all_matches(clauses: DataFrame, index: Index) -> DataFrame:
    """``*:*`` clauses: every document matches with score = boost."""
    every = clauses.where(F.col("kind") == "all").select("query_id", "clause_no", "occur", F.col("boost").alias("score"))
    return index.docs.select("doc_id").crossJoin(every).select("query_id", "clause_no", "occur", "doc_id", "score")


def clause_terms(clauses: DataFrame, analyzer: Analyzer) -> DataFrame:
    """Content term clauses -> analysed terms (one clause may give several), and exact ones as they are."""
    own = ["query_id", "clause_no", "occur", "kind", "boost"]
    c = clauses.where((F.col("kind") == "term") & (F.col("field") == "content"))
    toks = c.select(*own, F.posexplode(token_array(F.col("term"))).alias("token_no", "token"))
    exact = clauses.where((F.col("kind") == "exact") & (F.col("field") == "content")).select(*own, "term")
    return analyze_tokens(toks, analyzer).select(*own, "term").unionByName(exact.select(*own, "term"))


def settled_terms(clauses: DataFrame, analyzer: Analyzer) -> DataFrame:
    """:func:`clause_terms`, without any work for a small batch that has no term clause."""
    _, rows = settled(clauses)
    if rows is not None and not any(r["kind"] in TERM_KINDS and r["field"] == "content" for r in rows.to_pylist()):
        none = pa.table({"query_id": pa.array([], pa.int64()), "clause_no": pa.array([], pa.int64()), "occur": pa.array([], pa.string()),
                         "kind": pa.array([], pa.string()), "boost": pa.array([], pa.float64()), "term": pa.array([], pa.string())})
        return settled(clauses.sparkSession.createDataFrame(none))[0]
    return settled(clause_terms(clauses, analyzer))[0]


def match_clauses(clauses: DataFrame, terms: DataFrame, index: Index, quantized: bool = False,
                  max_expansions: int | None = None) -> DataFrame:
    """(query_id, clause_no, occur, doc_id, score) for every clause kind, a row
    for each clause and document at most.  ``terms`` comes from :func:`clause_terms`.

    Kinds that a small batch of clauses doesn't have leave no trace in the plan."""
    rows = settled(clauses)[1]
    has = lambda *kinds: rows is None or any(r["kind"] in kinds for r in rows.to_pylist())
    some = settled(terms)[1] is None or settled(terms)[1].num_rows
    multiterm = has("fuzzy", *SORTED_KINDS, *PATTERN_KINDS)
    content, n = _scored(terms if some else None, clauses if multiterm else None, index, quantized, max_expansions)
    named = field_matches(clauses, index) if has(*TERM_KINDS) else None
    if named is not None and content is not None and n is not None:
        named = dealt_by_rows(named, n, "doc_id")  # as the others are
    parts = [content, named, match_all_matches(clauses, index) if has("all") else None]
    parts = [p for p in parts if p is not None]
    if not parts:
        return index.postings.sparkSession.createDataFrame([], "query_id long, clause_no long, occur string, doc_id long, score double")
    return reduce(DataFrame.unionByName, parts)


def search_clauses(clauses: DataFrame, index: Index, quantized: bool = False, max_expansions: int | None = None) -> DataFrame:
    """Clause table -> (query_id, doc_id, score) of all matching documents."""
    clauses, _ = settled(checked(clauses))
    terms = settled_terms(clauses, index.analyzer)
    return combine(effective_clauses(clauses, terms), match_clauses(clauses, terms, index, quantized, max_expansions))
