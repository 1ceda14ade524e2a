"""Keyword-in-context snippets for search hits.

Works only on the hits of a search (at most k per query), so the per-hit
steps run as one row per (query, hit) after the top-k cut:

1. clauses: the analysed terms of each query (decorated clauses of a clause
   table never match a token);
2. keyword in context: every token of the hit whose term is a clause gives a
   fragment with two words of context on each side;
3. merge: overlapping or touching fragments are merged (gaps and islands
   over a running maximum of end offsets);
4. best fragments: fragments whose every term is covered by another kept
   fragment are dropped (an ordered fold over the last holders of a term, so
   over no more fragments than the query has terms), the rest ranked by
   number of terms then start;
5. bold: each term is bolded once, at its most central occurrence in the
   first fragment that has it; leading context is cut to two words;
6. assemble: fragments by start, joined with ``" ... "`` delimiters.

Steps 2-3 are rows and windows, without a copy of the text for each match;
steps 4-6 are higher-order array functions (``aggregate``, ``transform``,
``array_sort``) inside one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CONTEXT_WORDS, java_split_space, java_trim, token_array
from .analysis import Analyzer, analyze_tokens, first_term, first_term_of_column, tokenize_offsets
from .index import Index
from .lookup import settled, written


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.  Expressions inside
    higher-order functions share no common subexpressions, so a value used
    several times in a lambda is bound this way instead of repeated."""
    return F.element_at(F.transform(F.array(value), body), 1)


ELLIPSIS = " ... "


# --- clauses -------------------------------------------------------------------

def query_clauses(clause_terms: DataFrame) -> DataFrame:
    """(query_id, clauses ARRAY<STRING>): analysed terms in clause order."""
    s = clause_terms.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("clause_no", "term"))).alias("cs"))
    return s.select("query_id", F.transform("cs", lambda x: x["term"]).alias("clauses"))


def render_clauses(clauses: DataFrame, analyzer: Analyzer) -> DataFrame:
    """(query_id, clauses ARRAY<STRING>) for a clause table, written the way
    the query prints: bare analysed terms for plain should clauses, decorated
    text (+t, -t, (t)^2.0, t*, t~2, /re/, [a TO b], field:t, *:*) otherwise.

    Words of term clauses on the content are analysed, and stop words left
    out, as in the search; other terms stand as given."""
    analysed = (F.col("kind") == "term") & (F.col("field") == "content")
    toks = clauses.where(analysed).select("*", F.posexplode(token_array(F.col("term"))).alias("token_no", "token"))
    cols = ["query_id", "clause_no", "token_no", "occur", "field", "kind", "term", "term2", "boost"]
    rows = analyze_tokens(toks, analyzer).select(cols).unionByName(clauses.where(~analysed).withColumn("token_no", F.lit(0)).select(cols))
    kind, term = F.col("kind"), F.col("term")
    bounds = F.concat(F.coalesce(term, F.lit("*")), F.lit(" TO "), F.coalesce(F.col("term2"), F.lit("*")))
    body = (
        F.when(kind == "prefix", F.concat(term, F.lit("*")))
        .when(kind == "fuzzy", F.concat(term, F.lit("~"), F.coalesce(F.col("term2"), F.lit("2"))))
        .when(kind == "regexp", F.concat(F.lit("/"), term, F.lit("/")))
        .when(kind == "range", F.concat(F.lit("["), bounds, F.lit("]")))
        .when(kind == "range_exclusive", F.concat(F.lit("{"), bounds, F.lit("}")))
        .when(kind == "all", F.lit("*:*"))
        .otherwise(term)  # term, exact, wildcard
    )
    body = F.when((F.col("field") == "content") | (kind == "all"), body).otherwise(F.concat("field", F.lit(":"), body))
    body = F.when(F.col("boost") != 1.0, F.concat(F.lit("("), body, F.lit(")^"), F.col("boost").cast("string"))).otherwise(body)
    sign = F.when(F.col("occur") == "must", "+").when(F.col("occur") == "must_not", "-").otherwise("")
    printed = rows.select("query_id", "clause_no", "token_no", F.concat(sign, body).alias("txt")).where(F.col("txt").isNotNull())
    agg = printed.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("clause_no", "token_no", "txt"))).alias("cs"))
    return agg.select("query_id", F.flatten(F.transform("cs", lambda x: F.split(x["txt"], " "))).alias("clauses"))


# --- keyword in context ------------------------------------------------------------

def hit_contents(hits: DataFrame, docs: DataFrame | Index) -> DataFrame:
    """(doc_id, content, content_length) of the hit documents, newlines as spaces."""
    d = docs.documents(hits) if isinstance(docs, Index) else docs.join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    c = F.translate(F.coalesce(F.col("content"), F.lit("")), "\n", " ")
    return d.select("doc_id", c.alias("content"), F.length(c).alias("content_length"))


def prepare(hits: DataFrame, docs: DataFrame | Index) -> tuple[DataFrame, DataFrame]:
    """The hit list and the hit documents, each made once, so the steps below
    neither repeat the search nor rescan the corpus.

    A small hit list is taken as a local table, and a stored index then reads
    the folders and pages of these documents only."""
    h, rows = settled(hits.select("query_id", "doc_id"))
    if rows is None:
        h = written(h, "hits")
    return h, written(hit_contents(h, docs), "hit-docs")


def _last_words(prefix: Column) -> Column:
    """Last CONTEXT_WORDS space-separated words of trim(prefix), joined."""
    return F.substring_index(java_trim(prefix), " ", -CONTEXT_WORDS)


def _first_words(suffix: Column) -> Column:
    """First CONTEXT_WORDS space-separated words of trim(suffix), joined."""
    return F.substring_index(java_trim(suffix), " ", CONTEXT_WORDS)


def words_in_place(contents: DataFrame, analyzer: Analyzer) -> DataFrame:
    """(doc_id, word_no, word, word_start, first, back1, back2, next1, next2):
    the space-separated words of each text with their first terms and, as
    (word, first) structs, the two words before and after."""
    words = contents.select("doc_id", F.posexplode(F.split("content", " ")).alias("word_no", "word")).crossJoin(analyzer.stop_array())
    words = words.select("doc_id", "word_no", "word", first_term_of_column(F.col("word"), F.col("stop_arr"), analyzer).alias("first"))
    w = Window.partitionBy("doc_id").orderBy("word_no")
    start = F.coalesce(F.sum(F.length("word") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
    own = F.struct("word", "first")
    return words.select("doc_id", "word_no", "word", "first", start.alias("word_start"), F.lag(own, 1).over(w).alias("back1"), F.lag(own, 2).over(w).alias("back2"),
                        F.lead(own, 1).over(w).alias("next1"), F.lead(own, 2).over(w).alias("next2"))


def keyword_in_context(hits: DataFrame, contents: DataFrame, clauses: DataFrame, analyzer: Analyzer) -> DataFrame:
    """One fragment per matching token of each hit:
    (query_id, doc_id, token_no, term, start, end, text, terms, content_length).

    ``contents`` comes from :func:`prepare`.  A token's context are its
    neighbours by place: the rest of its own word on either side and the words
    before and after it.  Where a neighbour is empty or holds control signs
    (several blanks, tabs), what counts as a word depends on text further away;
    only then the context is cut from the text itself."""
    toks = tokenize_offsets(contents.select("doc_id", "content"), ["doc_id"], with_words=True)
    toks = toks.withColumn("term", analyzer.finish(analyzer.normalize(F.col("token"))))
    cterms = clauses.select("query_id", F.explode("clauses").alias("term")).distinct()
    m = toks.join(hits.select("query_id", "doc_id"), "doc_id").join(cterms, ["query_id", "term"])
    m = m.join(words_in_place(contents, analyzer), ["doc_id", "word_no"])
    left, right = F.substring("word", F.lit(1), F.col("start") - F.col("word_start")), F.substring("word", F.col("end") - F.col("word_start") + 1, F.length("word"))
    m = m.withColumn("l", left).withColumn("r", right)

    def usual(c: Column) -> Column:  # no neighbour, or one that trimming and splitting leave alone
        return c.isNull() | ((c != "") & ~c.rlike(r"[\x00-\x1f]"))

    def has(c: str) -> Column:
        return F.col(c) != ""

    near = usual(F.col("back1.word")) & (has("l") | usual(F.col("back2.word"))) & usual(F.col("next1.word")) & (has("r") | usual(F.col("next2.word")))
    m = m.withColumn("plain", near & ~F.col("word").rlike(r"[\x00-\x1f]"))
    before = F.when(has("l"), F.concat_ws(" ", "back1.word", "l")).otherwise(F.concat_ws(" ", "back2.word", "back1.word"))
    after = F.when(has("r"), F.concat_ws(" ", "r", "next1.word")).otherwise(F.concat_ws(" ", "next1.word", "next2.word"))
    lengths = contents.select("doc_id", "content_length")
    texts = contents.select(F.col("doc_id").alias("odd_doc"), "content")
    j = m.join(lengths, "doc_id").join(clauses, "query_id").crossJoin(analyzer.stop_array())
    j = j.join(texts, (F.col("doc_id") == F.col("odd_doc")) & ~F.col("plain"), "left")
    j = j.withColumn("before", F.when(F.col("plain"), before).otherwise(_last_words(F.substring("content", F.lit(1), F.col("start")))))
    j = j.withColumn("after", F.when(F.col("plain"), after).otherwise(_first_words(F.substring("content", F.col("end") + 1, F.length("content")))))

    first_of = lambda w: first_term(w, F.col("stop_arr"), analyzer)
    part = lambda c: F.when(F.col(c).rlike(r"[\p{L}\p{N}_]"), first_of(F.col(c))).otherwise("")  # noqa: E731  the rest of the token's own word
    ahead = F.when(has("l"), F.array("back1.first", part("l"))).otherwise(F.array("back2.first", "back1.first"))
    behind = F.when(has("r"), F.array(part("r"), "next1.first")).otherwise(F.array("next1.first", "next2.first"))
    taken = F.transform(F.concat(F.split("before", " "), F.split("after", " ")), first_of)
    around = F.when(F.col("plain"), F.array_compact(F.concat(ahead, behind))).otherwise(taken)
    terms = F.array_distinct(F.concat(F.array("term"), F.array_intersect(around, "clauses")))
    return j.select(
        "query_id", "doc_id", "token_no", "term",
        F.greatest(F.lit(0), F.col("start") - F.length("before") - 1).alias("start"),
        F.least(F.col("content_length"), F.col("end") + F.length("after") + 1).alias("end"),
        F.concat_ws(" ", "before", "token", "after").alias("text"), terms.alias("terms"), "content_length")


def islands(kwic: DataFrame) -> DataFrame:
    """(query_id, doc_id, island, start, end, merged, lone_text, terms, content_length):
    fragments that overlap or touch, in token order, as one.

    A fragment opens a new island when its start is beyond every earlier end
    (the running end starts at 0)."""
    w = Window.partitionBy("query_id", "doc_id").orderBy("token_no")
    prev_end = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    k = kwic.withColumn("new", (F.col("start") > F.coalesce(prev_end, F.lit(0))).cast("int"))
    k = k.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    g = k.groupBy("query_id", "doc_id", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"),
        F.min_by("text", "token_no").alias("lone_text"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"),
        F.first("content_length").alias("content_length"))
    return g.withColumn("merged", (F.col("n") > 1) | (F.col("island") == 0)).drop("n")


def with_texts(fragments: DataFrame, contents: DataFrame) -> DataFrame:
    """(query_id, doc_id, island, start, end, text, terms, content_length).

    Merged islands, and an island whose first fragment starts at 0, take their
    text from the content; a lone fragment keeps its context text."""
    cut = F.substring("content", F.col("start") + 1, F.col("end") - F.col("start"))
    return fragments.join(contents.select("doc_id", "content"), "doc_id").select(
        "query_id", "doc_id", "island", "start", "end", F.when(F.col("merged"), cut).otherwise(F.col("lone_text")).alias("text"), "terms", "content_length")


def merge_fragments(kwic: DataFrame, contents: DataFrame) -> DataFrame:
    """All merged fragments with their texts."""
    return with_texts(islands(kwic), contents)


def last_holders(fragments: DataFrame) -> DataFrame:
    """The fragments that are the last holder of one of their terms.

    Any other one is dropped by the redundancy fold and leaves no trace in it:
    each of its terms has a later holder.  So at most as many fragments of a
    hit as its query has terms go on, however often they match."""
    own = ["query_id", "doc_id", "island"]
    latest = Window.partitionBy("query_id", "doc_id", "term").orderBy(F.col("island").desc())
    held = fragments.withColumn("term", F.explode("terms")).withColumn("place", F.row_number().over(latest)).where("place = 1")
    return held.groupBy(*own).agg(*(F.first(c).alias(c) for c in fragments.columns if c not in own))


# --- array folds over the fragments of one hit -------------------------------------

def _best_fragments(frags: Column) -> Column:
    """Keep fragment i unless each of its terms is in another fragment that is
    later, or earlier and kept; rank by term count desc, start, order.

    A term is in a later fragment iff its last fragment index is beyond i,
    and in an earlier kept one iff it is in the union of kept terms carried by
    the fold, so each step is linear in the fragment's terms."""
    n = F.size(frags)
    idx = F.sequence(F.lit(0), n - 1)
    held = F.flatten(F.transform(frags, lambda f, i: F.transform(f["terms"], lambda t: F.struct(t.alias("t"), (-i).alias("i")))))
    # the last fragment of each term: the first entry of the term, the later fragments first
    last_map = let(F.array_sort(held), lambda h: F.map_from_entries(F.transform(F.filter(
        h, lambda x, k: (k == 0) | (F.get(h, k - 1)["t"] != x["t"])), lambda x: F.struct(x["t"], (-x["i"]).alias("i")))))
    init = F.struct(F.array().cast("array<string>").alias("kept"), F.array().cast("array<boolean>").alias("deleted"))

    def fold(last):
        def step(acc, i):
            def body(terms_i):
                gone = F.forall(terms_i, lambda t: (F.element_at(last, t) > i) | F.array_contains(acc["kept"], t))
                return let(gone, lambda g: F.struct(
                    F.when(g, acc["kept"]).otherwise(F.array_union(acc["kept"], terms_i)).alias("kept"),
                    F.concat(acc["deleted"], F.array(g)).alias("deleted")))
            return let(F.get(frags, i)["terms"], body)
        return F.aggregate(idx, init, step)["deleted"]

    def pick(deleted):
        tagged = F.transform(idx, lambda i: F.struct(
            F.get(frags, i)["start"].alias("start"), F.get(frags, i)["end"].alias("end"),
            F.get(frags, i)["text"].alias("text"), F.get(frags, i)["terms"].alias("terms"),
            i.alias("i"), F.get(deleted, i).alias("deleted")))
        return F.filter(tagged, lambda x: ~x["deleted"])

    kept = let(let(last_map, fold), pick)

    def order(a, b):
        by_terms = F.size(b["terms"]) - F.size(a["terms"])
        by_start = a["start"] - b["start"]
        return F.when(by_terms != 0, by_terms).when(by_start != 0, by_start).otherwise(a["i"] - b["i"])

    return F.array_sort(kept, order)


def _annotate(frag: Column, clauses: Column, stop_arr: Column, analyzer: Analyzer) -> Column:
    """Add words, their first terms, and per word whether it is the most
    central occurrence of its clause term (least summed distance to all
    clause words of the fragment, first such position).

    Distances use prefix sums over the (ascending) clause-word positions;
    the best position per term is the head of each term's run after one
    sort by (term, distance, position)."""
    words0 = java_split_space(frag["text"])

    def with_words(words):
        def with_terms(wt):
            pos = F.sequence(F.lit(0), F.size(words) - 1)

            def with_hits(hit):
                m = F.size(hit)
                # prefix[k] = sum of the first k hit positions (prefix[0] = 0)
                prefix0 = F.aggregate(hit, F.array(F.lit(0).cast("long")),
                                      lambda acc, h: F.concat(acc, F.array(F.element_at(acc, -1) + h.cast("long"))))

                def with_prefix(prefix):
                    total = F.element_at(prefix, -1)
                    cand = F.transform(hit, lambda h, k: F.struct(
                        F.get(wt, h).alias("t"),
                        (h.cast("long") * k - F.get(prefix, k) + (total - F.get(prefix, k + 1))
                         - h.cast("long") * (m - k - 1)).alias("d"),
                        h.alias("p")))

                    def heads(srt):
                        ks = F.filter(F.sequence(F.lit(0), m - 1),
                                      lambda k: (k == 0) | (F.get(srt, k)["t"] != F.get(srt, k - 1)["t"]))
                        return F.transform(ks, lambda k: F.get(srt, k)["p"])

                    best_pos = F.when(m > 0, let(F.array_sort(cand), heads)).otherwise(F.array().cast("array<int>"))
                    return let(best_pos, lambda bp: F.struct(
                        frag["start"].alias("start"), frag["end"].alias("end"), frag["text"].alias("text"),
                        frag["terms"].alias("terms"), words.alias("words"), wt.alias("wt"),
                        F.transform(pos, lambda p: F.array_contains(bp, p)).alias("best")))

                return let(prefix0, with_prefix)

            return let(F.filter(pos, lambda p: F.array_contains(clauses, F.get(wt, p))), with_hits)

        return let(F.transform(words, lambda w: first_term(w, stop_arr, analyzer)), with_terms)

    return let(words0, with_words)


def _bold(ranked: Column, absolute_offsets: bool = False) -> Column:
    """Fold over ranked fragments with the set of terms already bolded.

    A fragment whose leading context is cut starts at the number of signs cut
    (as the original rewrites it), or with ``absolute_offsets`` at its place in
    the text."""
    init = F.struct(F.array().cast("array<string>").alias("checked"),
                    F.array().cast("array<struct<rank:int,start:int,end:int,text:string>>").alias("out"))

    def step(acc, f):
        words, wt, best = f["words"], f["wt"], f["best"]
        size = F.size(words)
        pos = F.sequence(F.lit(0), size - 1)
        bold0 = F.transform(pos, lambda p: F.get(best, p) & ~F.array_contains(acc["checked"], F.get(wt, p)))

        def with_bold(bold):
            def with_pos(bold_pos):
                def with_fb(fb):
                    kept_before = F.slice(words, F.greatest(fb - 1, F.lit(1)), F.least(fb, F.lit(CONTEXT_WORDS)))
                    dropped = F.slice(words, F.lit(1), F.greatest(fb - CONTEXT_WORDS, F.lit(0)))
                    new_start = F.length(F.array_join(dropped, " "))
                    tail_words = F.slice(words, fb + 1, F.greatest(size - fb, F.lit(0)))
                    tail = F.array_join(F.transform(tail_words, lambda w, k: F.when(
                        F.get(bold, fb + k), F.concat(F.lit(" <b>"), w, F.lit("</b> ")))
                        .otherwise(F.concat(w, F.lit(" ")))), "")
                    has = fb.isNotNull()
                    text = F.when(has, F.concat(F.array_join(kept_before, " "), tail)).otherwise(f["text"])
                    moved = f["start"] + new_start if absolute_offsets else new_start
                    start = F.when(has & (new_start > 0), moved).otherwise(f["start"])
                    out = F.struct(F.size(acc["out"]).cast("int").alias("rank"), start.cast("int").alias("start"),
                                   f["end"].cast("int").alias("end"), text.alias("text"))
                    checked = F.array_union(acc["checked"], F.transform(bold_pos, lambda p: F.get(wt, p)))
                    return F.struct(checked.alias("checked"), F.concat(acc["out"], F.array(out)).alias("out"))
                return let(F.array_min(bold_pos), with_fb)
            return let(F.filter(pos, lambda p: F.get(bold, p)), with_pos)

        return let(bold0, with_bold)

    return F.aggregate(ranked, init, step)["out"]


def _assemble(out: Column, content_length: Column) -> Column:
    """Fragments by (rewritten) start, stable; " ... " before the first one if
    it does not start the text and no delimiter was written yet, and after
    each one that does not reach the end."""
    srt = F.array_sort(out, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
                       .otherwise(a["rank"] - b["rank"]))
    init = F.struct(F.lit(True).alias("first"), F.lit("").alias("s"))

    def step(acc, f):
        lead = acc["first"] & (f["start"] > 0)
        trail = content_length > f["end"]
        s = F.concat(acc["s"], F.when(lead, F.lit(ELLIPSIS)).otherwise(F.lit("")), f["text"],
                     F.when(trail, F.lit(ELLIPSIS)).otherwise(F.lit("")))
        return F.struct((acc["first"] & ~lead & ~trail).alias("first"), s.alias("s"))

    return F.aggregate(srt, init, step)["s"]


def best_fragments(merged: DataFrame) -> DataFrame:
    """(query_id, doc_id, content_length, ranked ARRAY<fragment>) after the
    redundancy fold and ranking.  Only the last holders of a term are gathered."""
    g = last_holders(merged).groupBy("query_id", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("island", "start", "end", "text", "terms"))).alias("frags"),
        F.first("content_length").alias("content_length"))
    return g.select("query_id", "doc_id", "content_length", _best_fragments(F.col("frags")).alias("ranked"))


def highlight_hits(hits: DataFrame, docs: DataFrame | Index, clauses: DataFrame, analyzer: Analyzer, absolute_offsets: bool = False) -> DataFrame:
    """(query_id, doc_id, highlight): snippet per hit, ``" "`` when nothing matches.

    ``absolute_offsets``: fragments are put in the order of their places in the
    text; the original's order goes by offsets that bolding rewrites."""
    hits, contents = prepare(hits, docs)
    kwic = keyword_in_context(hits, contents, clauses, analyzer)
    # texts are cut for the fragments that can stay only
    best = best_fragments(with_texts(last_holders(islands(kwic)), contents))
    stop = analyzer.stop_array()
    b = best.join(clauses, "query_id").crossJoin(stop)
    annotated = F.transform("ranked", lambda f: _annotate(f, F.col("clauses"), F.col("stop_arr"), analyzer))
    out = _bold(annotated, absolute_offsets)
    text = _assemble(out, F.col("content_length"))
    snippets = b.select("query_id", "doc_id", text.alias("highlight"))
    return hits.join(snippets, ["query_id", "doc_id"], "left").select(
        "query_id", "doc_id", F.coalesce(F.col("highlight"), F.lit(" ")).alias("highlight"))


def central_term_positions(merged: DataFrame, clauses: DataFrame, analyzer: Analyzer) -> DataFrame:
    """(query_id, doc_id, island, term, position): most central occurrence of
    each clause term in each merged fragment (word positions of the text)."""
    stop = analyzer.stop_array()
    m = merged.join(clauses, "query_id").crossJoin(stop)
    ann = _annotate(F.struct("start", "end", "text", "terms"), F.col("clauses"), F.col("stop_arr"), analyzer)
    a = m.select("query_id", "doc_id", "island", ann.alias("a"))
    e = a.select("query_id", "doc_id", "island", F.posexplode(F.arrays_zip(F.col("a.wt"), F.col("a.best"))).alias("position", "x"))
    return e.where(F.col("x.best")).select("query_id", "doc_id", "island", F.col("x.wt").alias("term"),
                                           F.col("position").cast("int").alias("position"))
