"""Independent SQL for every registered plan, run by DuckDB on the same
parquet tables (views ``documents``, ``benchmark``, ``conversations``,
``pages`` ...).  The logic is written a second time in SQL; only literal
values (token pattern, folding table, fixture inputs) are shared."""

from __future__ import annotations

from ..functions.html import html_to_text_sql
from ..functions.querysyntax import query_is_valid_sql
from ..functions.scoring import BM25_B, BM25_K1, quantized_length_sql
from ..functions.stem import stem_ctes
from ..functions.text import (MAX_HITS, TOKEN_PATTERN, java_split_space_sql, normalize_term_sql, sql_str,
                              strip_accents_sql, token_array_sql)
from .fixtures import FIXTURE_CLAUSES, FIXTURE_QUERIES, FIXTURE_STOPWORDS, SNIPPET_GROUPS

P = sql_str(TOKEN_PATTERN)


def _values(rows, cols: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return sql_str(v)
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({cols})"


def norm(expr: str) -> str:
    return normalize_term_sql(expr)


DOCS_DOCUMENTS = """
docs AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
         concat_ws('/', source, CAST(doc_id AS VARCHAR)) AS path,
         CAST(doc_id AS VARCHAR) AS file_name,
         coalesce(text, '') AS content
  FROM documents)"""


def base(docs_cte: str = DOCS_DOCUMENTS) -> str:
    return docs_cte + f""",
stop_raw AS (SELECT word FROM {_values([(w,) for w in FIXTURE_STOPWORDS], 'word')}),
stopset AS (SELECT word FROM stop_raw UNION SELECT {strip_accents_sql('word')} FROM stop_raw),
tok_lists AS (SELECT doc_id, {token_array_sql('content')} AS t FROM docs),
toks AS (SELECT doc_id, unnest(t) AS token, unnest(range(0, len(t))) AS token_no FROM tok_lists),
tokmap AS (SELECT token, {norm('token')} AS term FROM (SELECT DISTINCT token FROM toks)),
normed AS (SELECT t.doc_id, t.token_no, t.token, m.term FROM toks t JOIN tokmap m ON m.token = t.token),
terms AS (SELECT doc_id, token_no, term FROM normed WHERE term NOT IN (SELECT word FROM stopset)),
postings AS (SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf FROM terms GROUP BY doc_id, term),
doc_stats AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS dl FROM postings GROUP BY doc_id),
term_stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM postings GROUP BY term),
corpus AS (
  SELECT (SELECT count(*) FROM docs) AS num_docs,
         (SELECT count(*) FROM doc_stats) AS docs_with_terms,
         (SELECT CAST(coalesce(sum(dl), 0) AS BIGINT) FROM doc_stats) AS sum_dl,
         (SELECT CASE WHEN count(*) > 0 THEN sum(dl) / count(*) END FROM doc_stats) AS avg_dl,
         (SELECT max(doc_id) FROM docs) AS max_doc_id),
queries AS (SELECT CAST(query_id AS BIGINT) AS query_id, query FROM {_values(FIXTURE_QUERIES, 'query_id, query')}),
bench_queries AS (SELECT CAST(1000 + item_id AS BIGINT) AS query_id, coalesce(text, '') AS query FROM benchmark)
"""


BASE = base()
# as BASE, with the postings of stems
STEMMED = BASE.replace("postings AS (SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf FROM terms GROUP BY doc_id, term)",
                       "voc AS (SELECT DISTINCT term FROM terms)," + stem_ctes("voc", "stems") + """,
postings AS (SELECT t.doc_id, s.stem AS term, CAST(count(*) AS INTEGER) AS tf FROM terms t JOIN stems s ON s.term = t.term GROUP BY t.doc_id, s.stem)""")
STEMMED_CLAUSES = "cvoc AS (SELECT DISTINCT term FROM clauses)," + stem_ctes("cvoc", "cstems") + """,
stemmed_clauses AS (SELECT c.query_id, c.clause_no, s.stem AS term, c.boost FROM clauses c JOIN cstems s ON s.term = c.term)"""


def free_text(queries: str = "queries") -> str:
    """CTEs qwords/qtoks/clauses for a query relation."""
    return f"""
valid_q AS (SELECT * FROM {queries} WHERE {query_is_valid_sql('query')}),
qw_lists AS (SELECT query_id, {java_split_space_sql('query')} AS w FROM valid_q),
qwords AS (SELECT query_id, unnest(w) AS word, unnest(range(0, len(w))) AS word_no FROM qw_lists),
qt_lists AS (SELECT query_id, word_no, {token_array_sql('word')} AS t FROM qwords),
qtoks AS (SELECT query_id, word_no, unnest(t) AS token, unnest(range(0, len(t))) AS token_no FROM qt_lists),
clauses AS (
  SELECT query_id, CAST(word_no * 4294967296 + token_no AS BIGINT) AS clause_no, {norm('token')} AS term, 1.0 AS boost
  FROM qtoks WHERE {norm('token')} NOT IN (SELECT word FROM stopset))
"""


def bm25_sql(tf: str, dl: str, df: str, n: str, avgdl: str, boost: str) -> str:
    return (f"({boost} * ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5)) * "
            f"({tf} * {BM25_K1 + 1.0} / ({tf} + {BM25_K1} * ({1.0 - BM25_B} + {BM25_B} * {dl} / {avgdl}))))")


def scored(quantized: bool = False) -> str:
    dl = quantized_length_sql("p_dl") if quantized else "p_dl"
    return f"""
matched AS (
  SELECT c.query_id, c.clause_no, c.term, p.doc_id, p.tf, d.dl AS p_dl, coalesce(ts.df, 0) AS df, c.boost
  FROM clauses c JOIN postings p ON p.term = c.term JOIN doc_stats d ON d.doc_id = p.doc_id
  LEFT JOIN term_stats ts ON ts.term = c.term),
scores AS (
  SELECT query_id, doc_id, sum({bm25_sql('tf', dl, 'df', 'corpus.docs_with_terms', 'corpus.avg_dl', 'boost')}) AS score
  FROM matched, corpus GROUP BY query_id, doc_id)
"""


TOPK = f"""
topk AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS INTEGER) AS rank,
         doc_id, round(score, 6) AS score
  FROM scores QUALIFY rank <= {MAX_HITS})
"""

# The comparator isn't transitive, so the order is that of inserting the hits one by one: each goes before the
# last run of hits that it compares below, found from the end.
PLACED = """hits AS (SELECT query_id, list({'rank': rank, 'doc_id': doc_id, 'score': score} ORDER BY rank) AS l FROM topk GROUP BY query_id),
placed AS (
  SELECT query_id, list_reduce(list_transform(l, lambda x: [x]), lambda done, one:
    CASE WHEN len(list_filter(done, lambda h: floor(h.score - one[1].score + 0.5) <= 0)) = 0 THEN list_concat(one, done)
         ELSE list_concat(list_concat(
           done[1:list_max(list_transform(range(1, len(done) + 1), lambda i: CASE WHEN floor(done[i].score - one[1].score + 0.5) <= 0 THEN i ELSE 0 END))],
           one), done[list_max(list_transform(range(1, len(done) + 1), lambda i: CASE WHEN floor(done[i].score - one[1].score + 0.5) <= 0 THEN i ELSE 0 END)) + 1:])
    END) AS l FROM hits)
"""

ALL_WORDS = f"""
aw_lists AS (SELECT query_id, {java_split_space_sql('lower(query)')} AS w FROM queries WHERE {query_is_valid_sql('query')}),
all_words AS (SELECT query_id, unnest(w) AS word, CAST(unnest(range(0, len(w))) AS INTEGER) AS word_no FROM aw_lists),
aw_t AS (SELECT query_id, word_no, word, {token_array_sql('word')} AS t FROM all_words),
aw_toks AS (SELECT query_id, word_no, word, unnest(t) AS token, unnest(range(0, len(t))) AS token_no FROM aw_t),
word_terms AS (SELECT query_id, word_no, word, token_no, {norm('token')} AS term FROM aw_toks
               WHERE {norm('token')} NOT IN (SELECT word FROM stopset)),
word_df AS (
  SELECT w.query_id, w.word_no, w.word, CAST(coalesce(m.df, 0) AS BIGINT) AS df
  FROM all_words w LEFT JOIN (
    SELECT wt.query_id, wt.word_no, count(DISTINCT p.doc_id) AS df
    FROM word_terms wt JOIN postings p ON p.term = wt.term GROUP BY wt.query_id, wt.word_no) m
  ON m.query_id = w.query_id AND m.word_no = w.word_no),
word_idf AS (
  SELECT query_id, word_no, word, df,
         CASE WHEN df = 0 THEN CAST('Infinity' AS DOUBLE) ELSE log10(corpus.num_docs / df) END AS idf
  FROM word_df, corpus)
"""


def tfidf(key_expr_cte: str) -> str:
    return f""",
{key_expr_cte},
report AS (
  SELECT h.query_id, h.doc_id, k.word_no, k.word,
         CASE WHEN p.tf > 0 THEN 1 + log10(p.tf) ELSE 0.0 END AS tf, k.idf
  FROM topk h JOIN keyed k ON k.query_id = h.query_id
  LEFT JOIN postings p ON p.doc_id = h.doc_id AND p.term = k.key)
SELECT query_id, doc_id, word_no, word, tf, idf, tf * idf AS tfidf FROM report
"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts if p.strip()) + "\n"


def sql_plans() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_documents"] = with_(BASE) + "SELECT doc_id, path, file_name, content FROM docs"
    q["tokenize_offsets"] = with_(BASE, f"""
pieces_l AS (
  SELECT doc_id, string_split(regexp_replace(translate(content, chr(1), ' '), {P}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS p
  FROM docs),
pieces AS (SELECT doc_id, unnest(p) AS piece, unnest(range(0, len(p))) AS piece_no FROM pieces_l),
starts AS (
  SELECT doc_id, piece_no, piece,
         coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY piece_no
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM pieces)""") + """
SELECT doc_id, CAST((piece_no - 1) // 2 AS INTEGER) AS token_no, piece AS token, CAST(start AS INTEGER) AS start,
       CAST(start + length(piece) AS INTEGER) AS "end"
FROM starts WHERE piece_no % 2 = 1"""
    q["ascii_fold"] = with_(BASE) + f"""
SELECT DISTINCT token, {norm('token')} AS folded FROM toks WHERE strlen(token) <> length(token)"""
    q["remove_stopwords"] = with_(BASE) + """
SELECT d.doc_id, CAST(len(""" + token_array_sql("d.content") + """) AS BIGINT) AS n_tokens,
       CAST(coalesce(k.n_kept, 0) AS BIGINT) AS n_kept
FROM docs d LEFT JOIN (SELECT doc_id, count(*) AS n_kept FROM terms GROUP BY doc_id) k ON k.doc_id = d.doc_id"""
    q["analyze_documents"] = with_(BASE) + "SELECT doc_id, CAST(token_no AS INTEGER) AS token_no, term FROM terms"
    q["analyze_documents_stemmed"] = with_(BASE, "voc AS (SELECT DISTINCT term FROM terms)", stem_ctes("voc", "stems")) + \
        "SELECT t.doc_id, CAST(t.token_no AS INTEGER) AS token_no, s.stem AS term FROM terms t JOIN stems s ON s.term = t.term"
    q["stem_vocabulary"] = with_(BASE, stem_ctes("term_stats", "stems")) + "SELECT term, stem FROM stems"
    q["stopword_set"] = with_(BASE) + """
SELECT s.word, coalesce(n.df, 0) AS df FROM stopset s LEFT JOIN (
  SELECT term, count(DISTINCT doc_id) AS df FROM normed GROUP BY term) n ON n.term = s.word"""
    q["search_topk_stemmed"] = with_(STEMMED, free_text(), STEMMED_CLAUSES, scored().replace("FROM clauses c", "FROM stemmed_clauses c"), TOPK) + \
        "SELECT query_id, rank, doc_id, score FROM topk"
    q["first_term_of_word"] = with_(BASE, f"""
w_l AS (SELECT doc_id, {java_split_space_sql("translate(content, chr(10), ' ')")} AS w FROM docs),
words AS (SELECT doc_id, unnest(w) AS word, CAST(unnest(range(0, len(w))) AS INTEGER) AS word_no FROM w_l),
stop_list AS (SELECT list(word) AS l FROM stopset)""") + f"""
SELECT doc_id, word_no, word,
       coalesce(list_filter(list_transform({token_array_sql('word')}, lambda t: {norm('t')}),
                            lambda t: NOT list_contains(stop_list.l, t))[1], '') AS term
FROM words, stop_list"""
    q["term_frequencies"] = with_(BASE) + "SELECT doc_id, term, tf FROM postings"
    q["document_frequencies"] = with_(BASE) + "SELECT term, df, cf FROM term_stats"
    q["document_lengths"] = with_(BASE) + "SELECT doc_id, dl FROM doc_stats"
    q["corpus_stats"] = with_(BASE) + "SELECT num_docs, docs_with_terms, sum_dl, avg_dl, max_doc_id FROM corpus"
    q["build_postings"] = with_(BASE) + ("SELECT p.term, p.doc_id, p.tf, d.dl FROM postings p "
                                          "JOIN doc_stats d ON d.doc_id = p.doc_id")
    q["query_words"] = with_(BASE, f"""
qa AS (SELECT * FROM queries UNION ALL SELECT * FROM bench_queries),
l AS (SELECT query_id, {java_split_space_sql('lower(query)')} AS w FROM qa)""") + """
SELECT query_id, CAST(unnest(range(0, len(w))) AS INTEGER) AS word_no, unnest(w) AS word FROM l"""
    q["match_any"] = with_(BASE, free_text()) + """
SELECT c.query_id, c.clause_no, c.term, p.doc_id, p.tf FROM clauses c JOIN postings p ON p.term = c.term"""
    q["bm25_scores"] = with_(BASE, free_text(), scored()) + "SELECT query_id, doc_id, round(score, 6) AS score FROM scores"
    q["bm25_scores_quantized"] = with_(BASE, free_text(), scored(True)) + \
        "SELECT query_id, doc_id, round(score, 6) AS score FROM scores"
    q["search_topk"] = with_(BASE, free_text(), scored(), TOPK) + "SELECT query_id, rank, doc_id, score FROM topk"
    q["search_topk_benchmark"] = with_(BASE, free_text("bench_queries"), scored(), TOPK) + \
        "SELECT query_id, rank, doc_id, score FROM topk"
    q["query_total_hits"] = with_(BASE, free_text()) + """
SELECT q.query_id, coalesce(t.n, 0) AS total_hits FROM queries q LEFT JOIN (
  SELECT c.query_id, count(DISTINCT p.doc_id) AS n FROM clauses c JOIN postings p ON p.term = c.term
  GROUP BY c.query_id) t ON t.query_id = q.query_id"""
    q["search_status"] = with_(BASE, free_text(), scored(), TOPK) + f"""
SELECT q.query_id,
       CASE WHEN {query_is_valid_sql('q.query')} THEN 'success' ELSE 'error' END AS status,
       CAST(CASE WHEN {query_is_valid_sql('q.query')} THEN coalesce(n.n, 0) ELSE 0 END AS INTEGER) AS results_count
FROM queries q LEFT JOIN (SELECT query_id, count(*) AS n FROM topk GROUP BY query_id) n ON n.query_id = q.query_id"""
    q["search_display_order"] = with_(BASE, free_text(), scored(), TOPK, PLACED) + """
SELECT query_id, CAST(i - 1 AS INTEGER) AS display_pos, l[i].rank AS rank, l[i].doc_id AS doc_id, l[i].score AS score
FROM (SELECT query_id, l, unnest(range(1, len(l) + 1)) AS i FROM placed)"""
    q["query_word_df"] = with_(BASE, ALL_WORDS) + "SELECT query_id, word_no, word, df, idf FROM word_idf"
    q["tfidf_report"] = with_(BASE, free_text(), scored(), TOPK, ALL_WORDS) + tfidf(
        "keyed AS (SELECT *, substring(word, 1, length(word) - 1) AS key FROM word_idf)")
    q["tfidf_report_analyzed"] = with_(BASE, free_text(), scored(), TOPK, ALL_WORDS) + tfidf(
        """first_t AS (SELECT query_id, word_no, arg_min(term, token_no) AS key FROM word_terms GROUP BY query_id, word_no),
keyed AS (SELECT w.*, coalesce(f.key, '') AS key FROM word_idf w
          LEFT JOIN first_t f ON f.query_id = w.query_id AND f.word_no = w.word_no)""")
    return q


def edit_distance_sql(a: str, b: str) -> str:
    """DuckDB's own distance with exchanges, capped like the clause's edits."""
    return f"damerau_levenshtein({a}, {b})"


def clause_search_ctes(rows: list[tuple]) -> str:
    """Clause table -> scores, the boolean combination written in SQL."""
    cl = _values(rows, "query_id, clause_no, occur, field, kind, term, term2, boost")
    dist = edit_distance_sql("c.term", "v.term")
    like = "replace(replace(regexp_replace(c.term, '([%_\\\\])', '\\\\\\1', 'g'), '*', '%'), '?', '_')"
    return f"""
cl AS (SELECT CAST(query_id AS BIGINT) AS query_id, CAST(clause_no AS INTEGER) AS clause_no, occur, field, kind,
              term, term2, CAST(boost AS DOUBLE) AS boost FROM {cl}),
ct_l AS (SELECT query_id, clause_no, occur, boost, {token_array_sql('term')} AS t FROM cl
         WHERE kind = 'term' AND field = 'content'),
ct_u AS (SELECT query_id, clause_no, occur, boost, unnest(t) AS token FROM ct_l),
ct AS (SELECT query_id, clause_no, occur, boost, {norm('token')} AS term FROM ct_u
       WHERE {norm('token')} NOT IN (SELECT word FROM stopset)
       UNION ALL SELECT query_id, clause_no, occur, boost, term FROM cl WHERE kind = 'exact' AND field = 'content'),
tm AS (
  SELECT ct.query_id, ct.clause_no, ct.occur, p.doc_id,
         sum({bm25_sql('p.tf', 'd.dl', 'ts.df', 'corpus.docs_with_terms', 'corpus.avg_dl', 'ct.boost')}) AS score
  FROM ct JOIN postings p ON p.term = ct.term JOIN doc_stats d ON d.doc_id = p.doc_id
  JOIN term_stats ts ON ts.term = ct.term, corpus
  GROUP BY ct.query_id, ct.clause_no, ct.occur, p.doc_id),
names AS (SELECT 'fileName' AS field, file_name AS name, doc_id FROM docs UNION ALL SELECT 'path', path, doc_id FROM docs),
vocab AS (SELECT 'content' AS field, term, df FROM term_stats
          UNION ALL SELECT field, name, count(*) FROM names WHERE name IS NOT NULL GROUP BY field, name),
mc AS (SELECT *, CASE WHEN kind = 'fuzzy' THEN least(greatest(coalesce(TRY_CAST(term2 AS INTEGER), 2), 0), 2) ELSE 0 END AS edits
       FROM cl WHERE kind IN ('prefix', 'wildcard', 'regexp', 'range', 'range_exclusive', 'fuzzy')),
mt_join AS (
  SELECT c.query_id, c.clause_no, c.occur, c.kind, c.boost, c.edits, c.field, c.term AS qterm, v.term AS v, v.df,
         CASE WHEN c.kind = 'fuzzy' THEN {dist} ELSE 0 END AS dist
  FROM mc c JOIN vocab v ON c.field = v.field AND (
       (c.kind = 'prefix' AND starts_with(v.term, c.term))
    OR (c.kind = 'wildcard' AND v.term LIKE {like} ESCAPE '\\')
    OR (c.kind = 'regexp' AND regexp_full_match(v.term, c.term))
    OR (c.kind = 'range' AND (c.term IS NULL OR v.term >= c.term) AND (c.term2 IS NULL OR v.term <= c.term2))
    OR (c.kind = 'range_exclusive' AND (c.term IS NULL OR v.term > c.term) AND (c.term2 IS NULL OR v.term < c.term2))
    OR (c.kind = 'fuzzy' AND abs(length(v.term) - length(c.term)) <= c.edits))),
mt_exp AS (
  SELECT * FROM (
    SELECT *, CASE WHEN kind = 'fuzzy' THEN 1.0 - dist / least(length(qterm), length(v)) ELSE 1.0 END AS sim
    FROM mt_join WHERE dist <= edits) WHERE sim > 0),
mt_rows AS (
  SELECT e.query_id, e.clause_no, e.occur, e.kind, e.boost, p.doc_id,
         {bm25_sql('p.tf', 'd.dl', 'e.df', 'corpus.docs_with_terms', 'corpus.avg_dl', 'e.boost * e.sim')} AS score
  FROM mt_exp e JOIN postings p ON p.term = e.v JOIN doc_stats d ON d.doc_id = p.doc_id, corpus WHERE e.field = 'content'
  UNION ALL
  SELECT e.query_id, e.clause_no, e.occur, e.kind, e.boost, n.doc_id,
         e.boost * e.sim * ln(1 + (corpus.num_docs - e.df + 0.5) / (e.df + 0.5)) AS score
  FROM mt_exp e JOIN names n ON n.field = e.field AND n.name = e.v, corpus),
mt AS (
  SELECT query_id, clause_no, occur, doc_id, CASE WHEN kind = 'fuzzy' THEN sum(score) ELSE max(boost) END AS score
  FROM mt_rows GROUP BY query_id, clause_no, occur, kind, doc_id),
fm_rows AS (
  SELECT c.query_id, c.clause_no, c.occur, c.boost, n.doc_id, count(*) OVER (PARTITION BY c.query_id, c.clause_no) AS df
  FROM cl c JOIN names n ON n.field = c.field AND n.name = c.term WHERE c.kind IN ('term', 'exact') AND c.field <> 'content'),
fm AS (
  SELECT query_id, clause_no, occur, doc_id, sum(boost * ln(1 + (corpus.num_docs - df + 0.5) / (df + 0.5))) AS score
  FROM fm_rows, corpus GROUP BY query_id, clause_no, occur, doc_id),
m AS (SELECT * FROM tm UNION ALL SELECT * FROM mt UNION ALL SELECT * FROM fm),
allc AS (SELECT query_id, clause_no, occur, boost FROM cl WHERE kind = 'all'),
am AS (SELECT a.query_id, a.clause_no, a.occur, d.doc_id, a.boost AS score FROM docs d, allc a),
mm AS (SELECT * FROM m UNION ALL SELECT * FROM am),
eff AS (SELECT DISTINCT query_id, clause_no, occur FROM (
          SELECT query_id, clause_no, occur FROM ct
          UNION ALL SELECT query_id, clause_no, occur FROM cl WHERE kind NOT IN ('term', 'exact') OR field <> 'content')),
req AS (SELECT query_id, count(DISTINCT CASE WHEN occur = 'must' THEN clause_no END) AS n_must FROM eff GROUP BY query_id),
pos AS (
  SELECT query_id, doc_id, sum(score) AS score,
         count(DISTINCT CASE WHEN occur = 'must' THEN clause_no END) AS must_hit,
         count(CASE WHEN occur = 'should' THEN 1 END) AS should_hit
  FROM mm WHERE occur <> 'must_not' GROUP BY query_id, doc_id),
excl AS (SELECT DISTINCT query_id, doc_id FROM mm WHERE occur = 'must_not'),
scores AS (
  SELECT p.query_id, p.doc_id, p.score FROM pos p JOIN req r ON r.query_id = p.query_id
  WHERE p.must_hit = r.n_must AND (r.n_must > 0 OR p.should_hit > 0)
    AND NOT EXISTS (SELECT 1 FROM excl e WHERE e.query_id = p.query_id AND e.doc_id = p.doc_id))
"""


def clause_search_sql(group: str) -> str:
    return with_(BASE, clause_search_ctes(FIXTURE_CLAUSES[group]), TOPK) + "SELECT query_id, rank, doc_id, score FROM topk"


# How a clause table prints, word by word; ``clauses`` as the snippets' SQL reads it.
PRINTED = """
printed AS (
  SELECT query_id, clause_no, 0 AS token_no, occur, boost, CASE WHEN kind <> 'all' AND field <> 'content' THEN field || ':' ELSE '' END || CASE kind
      WHEN 'prefix' THEN term || '*' WHEN 'fuzzy' THEN term || '~' || coalesce(term2, '2') WHEN 'regexp' THEN '/' || term || '/'
      WHEN 'range' THEN '[' || coalesce(term, '*') || ' TO ' || coalesce(term2, '*') || ']'
      WHEN 'range_exclusive' THEN '{' || coalesce(term, '*') || ' TO ' || coalesce(term2, '*') || '}'
      WHEN 'all' THEN '*:*' ELSE term END AS body
  FROM cl WHERE kind <> 'term' OR field <> 'content'
  UNION ALL
  SELECT query_id, clause_no, token_no, occur, boost, term FROM (
    SELECT query_id, clause_no, occur, boost, unnest(t) AS token, unnest(range(0, len(t))) AS token_no FROM ct_l) JOIN (
    SELECT token, %NORM% AS term FROM (SELECT DISTINCT token FROM ct_u)) USING (token) WHERE term NOT IN (SELECT word FROM stopset)),
clause_words AS (
  SELECT query_id, clause_no, token_no, string_split(CASE occur WHEN 'must' THEN '+' WHEN 'must_not' THEN '-' ELSE '' END ||
    CASE WHEN boost <> 1 THEN '(' || body || ')^' || CAST(boost AS VARCHAR) ELSE body END, ' ') AS w FROM printed),
clauses AS (
  SELECT query_id, (clause_no * 4096 + token_no) * 4096 + place AS clause_no, word AS term
  FROM (SELECT query_id, clause_no, token_no, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM clause_words))
""".replace("%NORM%", norm("token"))


CLAUSE_KEYS = {
    "match_boolean": "boolean", "score_boosted": "boosted", "match_wildcard": "wildcard", "match_fuzzy": "fuzzy",
    "match_regexp": "regexp", "match_term_range": "range", "match_field": "field", "match_all": "all",
}


def all_sql() -> dict[str, str]:
    q = sql_plans()
    for key, group in CLAUSE_KEYS.items():
        q[key] = clause_search_sql(group)
    return q


def _first_term_sql(w: str) -> str:
    return (f"coalesce(list_filter(list_transform({token_array_sql(w)}, lambda t: {norm('t')}), "
            f"lambda t: NOT list_contains(stop_list.l, t))[1], '')")


HL = f"""
stop_list AS (SELECT list(word) AS l FROM stopset),
qcl AS (SELECT query_id, list(term ORDER BY clause_no) AS clauses FROM clauses GROUP BY query_id),
hdocs AS (SELECT doc_id, translate(content, chr(10), ' ') AS content FROM docs WHERE doc_id IN (SELECT doc_id FROM topk)),
hp_l AS (SELECT doc_id, string_split(regexp_replace(translate(content, chr(1), ' '), {P}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS p
         FROM hdocs),
hp AS (SELECT doc_id, unnest(p) AS piece, unnest(range(0, len(p))) AS piece_no FROM hp_l),
hps AS (SELECT doc_id, piece_no, piece,
               CAST(coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY piece_no
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
        FROM hp),
htoks AS (SELECT doc_id, (piece_no - 1) // 2 AS token_no, piece AS token, start, start + length(piece) AS "end"
          FROM hps WHERE piece_no % 2 = 1),
hmatch AS (
  SELECT h.query_id, t.doc_id, t.token_no, t.token, {norm('t.token')} AS term, t.start, t."end"
  FROM htoks t JOIN topk h ON h.doc_id = t.doc_id
  JOIN (SELECT DISTINCT query_id, term FROM clauses) c ON c.query_id = h.query_id AND c.term = {norm('t.token')}),
kw1 AS (
  SELECT m.*, length(d.content) AS content_length, q.clauses,
         {java_split_space_sql(f"regexp_replace(substring(d.content, 1, m.start), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')")} AS bw,
         {java_split_space_sql(f"regexp_replace(substring(d.content, m.\"end\" + 1), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')")} AS aw
  FROM hmatch m JOIN hdocs d ON d.doc_id = m.doc_id JOIN qcl q ON q.query_id = m.query_id),
kw2 AS (SELECT *, list_slice(bw, greatest(len(bw) - 1, 1), len(bw)) AS bw2, list_slice(aw, 1, 2) AS aw2 FROM kw1),
kw AS (
  SELECT query_id, doc_id, CAST(token_no AS INTEGER) AS token_no, term,
         CAST(greatest(0, start - length(array_to_string(bw2, ' ')) - 1) AS INTEGER) AS start,
         CAST(least(content_length, "end" + length(array_to_string(aw2, ' ')) + 1) AS INTEGER) AS "end",
         array_to_string(bw2, ' ') || ' ' || token || ' ' || array_to_string(aw2, ' ') AS text,
         list_sort(list_distinct(list_concat([term], list_filter(
             list_transform(list_concat(bw2, aw2), lambda w: {_first_term_sql('w')}),
             lambda t: list_contains(clauses, t))))) AS terms,
         CAST(content_length AS INTEGER) AS content_length
  FROM kw2, stop_list),
kw_i AS (SELECT *, CASE WHEN start > coalesce(max("end") OVER (PARTITION BY query_id, doc_id ORDER BY token_no
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) THEN 1 ELSE 0 END AS new FROM kw),
kw_j AS (SELECT *, sum(new) OVER (PARTITION BY query_id, doc_id ORDER BY token_no
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM kw_i),
mg AS (SELECT query_id, doc_id, island, min(start) AS start, max("end") AS "end", count(*) AS n,
              arg_min(text, token_no) AS lone_text, list_sort(list_distinct(flatten(list(terms)))) AS terms,
              any_value(content_length) AS content_length
       FROM kw_j GROUP BY query_id, doc_id, island),
merged AS (
  SELECT query_id, mg.doc_id, CAST(island AS INTEGER) AS island, start, "end",
         CASE WHEN n > 1 OR island = 0 THEN substring(d.content, start + 1, "end" - start) ELSE lone_text END AS text,
         terms, content_length
  FROM mg JOIN hdocs d ON d.doc_id = mg.doc_id)
"""


# The fold over all fragments of a hit, one by one: a fragment goes if each term that it is the last to hold is kept already.
BEST = """
frag AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY island) AS i FROM merged),
frag_terms AS (SELECT query_id, doc_id, i, unnest(terms) AS term FROM frag),
last_of AS (SELECT query_id, doc_id, term, max(i) AS i FROM frag_terms GROUP BY ALL),
owned AS (SELECT query_id, doc_id, i, list(term) AS own FROM last_of GROUP BY ALL),
chain AS (SELECT f.*, coalesce(o.own, []) AS own FROM frag f LEFT JOIN owned o ON o.query_id = f.query_id AND o.doc_id = f.doc_id AND o.i = f.i),
fold(query_id, doc_id, i, kept, gone) AS (
  SELECT DISTINCT query_id, doc_id, CAST(0 AS BIGINT), []::VARCHAR[], true FROM chain
  UNION ALL
  SELECT c.query_id, c.doc_id, c.i, CASE WHEN list_has_all(s.kept, c.own) THEN s.kept ELSE list_distinct(list_concat(s.kept, c.terms)) END,
         list_has_all(s.kept, c.own)
  FROM fold s JOIN chain c ON c.query_id = s.query_id AND c.doc_id = s.doc_id AND c.i = s.i + 1),
best AS (
  SELECT f.*, row_number() OVER (PARTITION BY f.query_id, f.doc_id ORDER BY len(f.terms) DESC, f.start, f.i) - 1 AS rank
  FROM frag f JOIN fold s ON s.query_id = f.query_id AND s.doc_id = f.doc_id AND s.i = f.i WHERE NOT s.gone)
"""


def _snippets() -> str:
    """CTE ``snippet``(query_id, doc_id, highlight): the most central word of each term bolded where it comes first by rank."""
    return f"""
bw_l AS (SELECT query_id, doc_id, rank, {java_split_space_sql('text')} AS w FROM best),
bw AS (SELECT query_id, doc_id, rank, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM bw_l),
bwt AS (SELECT bw.query_id, doc_id, rank, p, {_first_term_sql('word')} AS term FROM bw, stop_list),
bhit AS (SELECT b.* FROM bwt b JOIN qcl q ON q.query_id = b.query_id WHERE list_contains(q.clauses, b.term)),
bdist AS (
  SELECT a.query_id, a.doc_id, a.rank, a.term, a.p, sum(abs(a.p - b.p)) AS dist
  FROM bhit a JOIN bhit b ON a.query_id = b.query_id AND a.doc_id = b.doc_id AND a.rank = b.rank GROUP BY ALL),
central AS (SELECT * FROM bdist QUALIFY row_number() OVER (PARTITION BY query_id, doc_id, rank, term ORDER BY dist, p) = 1),
marks AS (SELECT query_id, doc_id, rank, list({{'t': term, 'p': p}} ORDER BY p) AS m FROM central GROUP BY ALL),
shown AS (
  SELECT b.query_id, b.doc_id, b.rank, b.start, b."end", b.text, b.content_length, l.w, coalesce(k.m, []) AS m FROM best b
  JOIN bw_l l ON l.query_id = b.query_id AND l.doc_id = b.doc_id AND l.rank = b.rank
  LEFT JOIN marks k ON k.query_id = b.query_id AND k.doc_id = b.doc_id AND k.rank = b.rank),
bolded(query_id, doc_id, rank, done, bold) AS (
  SELECT DISTINCT query_id, doc_id, CAST(-1 AS BIGINT), []::VARCHAR[], []::BIGINT[] FROM shown
  UNION ALL
  SELECT s.query_id, s.doc_id, s.rank, list_distinct(list_concat(d.done, list_transform(s.m, lambda x: x.t))),
         list_transform(list_filter(s.m, lambda x: NOT list_contains(d.done, x.t)), lambda x: x.p)
  FROM bolded d JOIN shown s ON s.query_id = d.query_id AND s.doc_id = d.doc_id AND s.rank = d.rank + 1),
cut AS (
  SELECT s.query_id, s.doc_id, s.rank, s."end", s.content_length, list_min(d.bold) AS f,
         CASE WHEN len(d.bold) = 0 THEN s.text ELSE array_to_string(s.w[greatest(f - 1, 1):f], ' ') || array_to_string(list_transform(
           range(f, len(s.w)), lambda p: CASE WHEN list_contains(d.bold, p) THEN ' <b>' || s.w[p + 1] || '</b> ' ELSE s.w[p + 1] || ' ' END), '') END AS text,
         CASE WHEN f > 2 AND length(array_to_string(s.w[1:f - 2], ' ')) > 0 THEN length(array_to_string(s.w[1:f - 2], ' ')) ELSE s.start END AS start
  FROM shown s JOIN bolded d ON d.query_id = s.query_id AND d.doc_id = s.doc_id AND d.rank = s.rank),
ordered AS (
  SELECT *, coalesce(bool_and(start <= 0 AND content_length <= "end") OVER (
    PARTITION BY query_id, doc_id ORDER BY start, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS bare FROM cut),
snippet AS (
  SELECT query_id, doc_id, string_agg(CASE WHEN bare AND start > 0 THEN ' ... ' ELSE '' END || text ||
    CASE WHEN content_length > "end" THEN ' ... ' ELSE '' END, '' ORDER BY start, rank) AS highlight
  FROM ordered GROUP BY query_id, doc_id),
highlighted AS (
  SELECT h.query_id, h.doc_id, coalesce(s.highlight, ' ') AS highlight FROM topk h
  LEFT JOIN snippet s ON s.query_id = h.query_id AND s.doc_id = h.doc_id)
"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def highlight_sql() -> dict[str, str]:
    head = with_(BASE, free_text(), scored(), TOPK, HL)
    q = {}
    q["keyword_in_context"] = head + 'SELECT query_id, doc_id, token_no, term, start, "end", text, terms, content_length FROM kw'
    q["merge_fragments"] = head + 'SELECT query_id, doc_id, island, start, "end", text, terms, content_length FROM merged'
    q["central_term_positions"] = with_(BASE, free_text(), scored(), TOPK, HL, f"""
cw_l AS (SELECT query_id, doc_id, island, {java_split_space_sql('text')} AS w FROM merged),
cw AS (SELECT query_id, doc_id, island, unnest(w) AS word, unnest(range(0, len(w))) AS position FROM cw_l),
cwt AS (SELECT cw.*, {_first_term_sql('word')} AS term FROM cw, stop_list),
chit AS (SELECT c.* FROM cwt c JOIN qcl q ON q.query_id = c.query_id WHERE list_contains(q.clauses, c.term)),
cdist AS (SELECT a.query_id, a.doc_id, a.island, a.term, a.position, sum(abs(a.position - b.position)) AS dist
          FROM chit a JOIN chit b ON a.query_id = b.query_id AND a.doc_id = b.doc_id AND a.island = b.island
          GROUP BY a.query_id, a.doc_id, a.island, a.term, a.position)""") + """
SELECT query_id, doc_id, island, term, CAST(position AS INTEGER) AS position FROM cdist
QUALIFY row_number() OVER (PARTITION BY query_id, doc_id, island, term ORDER BY dist, position) = 1"""
    q["best_fragments"] = recursive(with_(BASE, free_text(), scored(), TOPK, HL, BEST)) + """
SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank, start, "end", text, terms FROM best"""
    q["highlight"] = recursive(with_(BASE, free_text(), scored(), TOPK, HL, BEST, _snippets())) + "SELECT query_id, doc_id, highlight FROM highlighted"
    rows = [row for group in SNIPPET_GROUPS for row in FIXTURE_CLAUSES[group]]
    q["highlight_clause_table"] = recursive(with_(BASE, clause_search_ctes(rows), TOPK, PRINTED, HL, BEST, _snippets())) + \
        "SELECT query_id, doc_id, highlight FROM highlighted"
    q["search_response"] = recursive(with_(BASE, free_text(), scored(), TOPK, HL, BEST, _snippets(), PLACED, f"""
answers AS (
  SELECT p.query_id, '[' || string_agg('{{"content":' || to_json(h.highlight) || ',"fileName":' || to_json(d.file_name) || '}}', ',' ORDER BY p.i) || ']' AS results
  FROM (SELECT query_id, l[i].doc_id AS doc_id, i FROM (SELECT query_id, l, unnest(range(1, len(l) + 1)) AS i FROM placed)) p
  JOIN highlighted h ON h.query_id = p.query_id AND h.doc_id = p.doc_id JOIN docs d ON d.doc_id = p.doc_id GROUP BY p.query_id),
states AS (
  SELECT q.query_id, CASE WHEN {query_is_valid_sql('q.query')} THEN 'success' ELSE 'error' END AS status,
         CAST(CASE WHEN {query_is_valid_sql('q.query')} THEN coalesce(n.n, 0) ELSE 0 END AS INTEGER) AS results_count
  FROM queries q LEFT JOIN (SELECT query_id, count(*) AS n FROM topk GROUP BY query_id) n ON n.query_id = q.query_id)""")) + """
SELECT s.query_id, status, results_count, '{"searchDetails":{"status":"' || status || '","resultsCount":"' || results_count ||
       '"},"searchResults":' || coalesce(a.results, '[]') || '}' AS response
FROM states s LEFT JOIN answers a ON a.query_id = s.query_id"""
    q["highlight_clauses"] = with_(BASE, free_text("bench_queries")) + \
        "SELECT query_id, list(term ORDER BY clause_no) AS clauses FROM clauses GROUP BY query_id"
    return q


def all_sql_with_highlight() -> dict[str, str]:
    q = all_sql()
    q.update(highlight_sql())
    return q


def url_file_name_sql(expr: str) -> str:
    no_q = f"regexp_replace({expr}, '[?#].*$', '')"
    no_host = f"regexp_replace({no_q}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*', '')"
    return f"string_split({no_host}, '/')[-1]"


DOCS_PAGES = f"""
docs AS (
  SELECT CAST(page_id AS BIGINT) AS doc_id, url AS path, {url_file_name_sql('url')} AS file_name,
         {html_to_text_sql('html')} AS content
  FROM pages)"""

DOCS_WITH_CONVERSATIONS = """
docs AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS content FROM documents
  UNION ALL
  SELECT CAST((SELECT max(doc_id) + 1 FROM documents) + conv_id * 4294967296 + turn AS BIGINT) AS doc_id,
         coalesce(text, '') AS content FROM conversations)"""


def source_sql() -> dict[str, str]:
    q = {}
    q["extract_page_text"] = with_(DOCS_PAGES) + "SELECT doc_id, path, file_name, content FROM docs"
    q["document_metadata"] = with_(DOCS_PAGES) + "SELECT doc_id, path, file_name FROM docs"
    q["search_pages_topk"] = with_(base(DOCS_PAGES), free_text(), scored(), TOPK) + \
        "SELECT query_id, rank, doc_id, score FROM topk"
    q["index_append_stats"] = with_(base(DOCS_WITH_CONVERSATIONS)) + "SELECT term, df, cf FROM term_stats"
    return q


def every_sql() -> dict[str, str]:
    q = all_sql_with_highlight()
    q.update(source_sql())
    return q
