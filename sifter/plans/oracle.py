"""DuckDB SQL for the correctness oracles: helpers that render the same
profiles and whitespace rule as RE2 / SQL text, and the derived views of
FIXTURES.md as common table expressions."""

from __future__ import annotations

import string

from ..functions.text import (CORPUS_PROFILE, REPLACEMENT_CHAR, RETRIEVAL_PROFILE, SLIDE_PROFILE_DE,
                              SLIDE_PROFILE_OTHER, WHITESPACE_CHARS, re2_class)
from ..sources.fixtures import LINES_PER_PAGE, TEST_STOPWORDS

WS_RE2 = re2_class(WHITESPACE_CHARS)
NON_WS_RE2 = re2_class(WHITESPACE_CHARS, negate=True)
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE_CHARS) + ")"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chain(expr: str, pairs) -> str:
    for pat, rep in pairs:
        expr = f"regexp_replace({expr}, {lit(pat)}, {lit(rep)}, 'g')"
    return expr


def t2(expr: str) -> str:
    return chain(expr, RETRIEVAL_PROFILE)


def t3(expr: str) -> str:
    return chain(expr, CORPUS_PROFILE)


def slide(expr: str, lang: str) -> str:
    return chain(expr, SLIDE_PROFILE_DE if lang == "de" else SLIDE_PROFILE_OTHER)


def strip(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


def not_blank(expr: str) -> str:
    return f"regexp_matches({expr}, {lit(NON_WS_RE2)})"


def tokens(expr: str) -> str:
    return f"regexp_split_to_array({expr}, {lit(WS_RE2)})"


def terms(expr: str) -> str:
    """lower-cased whitespace tokens without empties (list)"""
    return f"list_filter({tokens(f'lower({expr})')}, lambda t: t <> '')"


STOPWORDS_SQL = "[" + ", ".join(lit(w) for w in TEST_STOPWORDS) + "]"
FFFD = lit(REPLACEMENT_CHAR)


def clean_tokens_line(expr: str, with_stopwords: bool = True, terminated: bool = True) -> str:
    text = f"({expr} || chr(10))" if terminated else expr
    toks = tokens(text)
    if with_stopwords:
        toks = (f"list_filter({toks}, lambda t: contains(t, {FFFD}) OR NOT list_contains({STOPWORDS_SQL}, t))")
    masked = f"list_transform({toks}, lambda t: CASE WHEN contains(t, {FFFD}) THEN '<UNK>' ELSE t END)"
    return f"array_to_string({masked}, ' ')"


def letters(expr: str) -> str:
    """Counts of the letters a-z, either case, as a list of doubles."""
    counts = (f"2 * length({expr}) - length(replace({expr}, '{c}', '')) - length(replace({expr}, '{c.upper()}', ''))"
              for c in string.ascii_lowercase)
    return "CAST([" + ", ".join(counts) + "] AS DOUBLE[])"


P = LINES_PER_PAGE

# ---------------------------------------------------------------------------
# Derived views
# ---------------------------------------------------------------------------
CTE = {
    "doc_lines": """doc_lines AS (
  SELECT doc_id,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents)""",
    "damaged_lines": f"""damaged_lines AS (
  SELECT doc_id, line_no, replace(line, 'é', {FFFD}) AS line FROM doc_lines)""",
    "passages": f"""passages AS (
  SELECT doc_id, line_no // {P} AS page_no, line_no, passage FROM (
    SELECT doc_id, line_no, {t2(strip('line'))} AS passage FROM doc_lines)
  WHERE {not_blank('passage')})""",
    "doc_pages": f"""doc_pages AS (
  SELECT doc_id, line_no // {P} AS page_no, string_agg(line, chr(10) ORDER BY line_no) AS page_raw
  FROM doc_lines GROUP BY doc_id, line_no // {P})""",
    "pages_clean": f"""pages_clean AS (
  SELECT doc_id, page_no, context, replace(lower(context), chr(962), chr(963)) AS page_lc FROM (
    SELECT doc_id, page_no, {t2('page_raw')} AS context FROM doc_pages))""",
    "elements": f"""elements AS (
  SELECT doc_id, line_no // {P} AS page_no, CAST(line_no % {P} AS BIGINT) AS elem_ix,
         CAST(800 AS DOUBLE) - CAST(10 AS DOUBLE) * CAST((line_no * 3 % {P}) // 2 AS DOUBLE) AS y1,
         kind, line,
         CASE WHEN kind IN ('text', 'figure') THEN line || chr(10) END AS text,
         CASE WHEN kind = 'rect' THEN [list_transform(string_split(line, '|'),
                                                      lambda c: nullif(replace(c, ' ', chr(10)), ''))] END AS tbl
  FROM (SELECT *, CASE WHEN contains(line, '|') THEN 'rect'
                       WHEN (doc_id + line_no) % 11 = 0 THEN 'figure'
                       WHEN (doc_id + line_no) % 7 = 0 THEN 'curve' ELSE 'text' END AS kind
        FROM doc_lines))""",
    # reading order and the table-suppression rule per element
    "marked": """ordered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY y1 DESC, elem_ix) - 1 AS BIGINT) AS ord
  FROM elements),
marked AS (
  SELECT *,
         CASE WHEN kind = 'figure' THEN TRUE
              WHEN kind = 'text' THEN (n_tables = 0 OR first_rect IS NULL OR ord < first_rect)
              ELSE (n_tables > 0 AND ord = first_rect) END AS keep
  FROM (SELECT *,
               min(CASE WHEN kind = 'rect' THEN ord END) OVER (PARTITION BY doc_id, page_no) AS first_rect,
               count(CASE WHEN kind = 'rect' THEN tbl END) OVER (PARTITION BY doc_id, page_no) AS n_tables
        FROM ordered))""",
    "page_tables": """page_tables AS (
  SELECT doc_id, page_no, list(tbl ORDER BY ord) AS tables
  FROM marked WHERE kind = 'rect' AND tbl IS NOT NULL GROUP BY doc_id, page_no)""",
    "entries": """entries AS (
  SELECT m.doc_id, m.page_no, m.ord, m.kind, m.keep,
         CASE m.kind WHEN 'text' THEN m.text WHEN 'figure' THEN 'image' ELSE 'table' END AS part_text,
         CASE m.kind WHEN 'text' THEN 'text' WHEN 'figure' THEN 'image' ELSE 'table' END AS fmt_kind,
         CASE WHEN m.kind = 'text' THEN list_sort(list_distinct(list_transform(
                   list_filter(string_split(m.line, ' '), lambda w: w <> ''), lambda w: substring(w, 1, 1))))
              ELSE [] END AS fonts,
         CASE WHEN m.kind = 'text' THEN list_sort(list_distinct(list_transform(
                   list_filter(string_split(m.line, ' '), lambda w: w <> ''), lambda w: CAST(length(w) AS DOUBLE))))
              ELSE [] END AS sizes,
         CASE WHEN m.kind = 'rect' THEN TABLE_TEXT(pt.tables[1]) ELSE m.text END AS content
  FROM marked m LEFT JOIN page_tables pt USING (doc_id, page_no))""",
    "page_records": """page_records AS (
  SELECT doc_id, page_no,
         coalesce(list(part_text ORDER BY ord) FILTER (WHERE keep), []) AS page_text,
         coalesce(list(fmt_kind || ':' || array_to_string(fonts, ',') || ':'
                       || array_to_string(list_transform(sizes, lambda s: CAST(CAST(s AS BIGINT) AS VARCHAR)), ',')
                  ORDER BY ord) FILTER (WHERE keep), []) AS line_format,
         coalesce(list(content ORDER BY ord) FILTER (WHERE keep AND kind = 'figure'), []) AS text_from_images,
         coalesce(list(content ORDER BY ord) FILTER (WHERE keep AND kind = 'rect'), []) AS text_from_tables,
         coalesce(list(content ORDER BY ord) FILTER (WHERE keep), []) AS page_content
  FROM entries GROUP BY doc_id, page_no)""",
    # several tables a page: regions of rectangles by their extents
    "regions": """handled AS (
  SELECT *, lag(kind) OVER w AS last_kind, min(table_y0) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lowest FROM (
    SELECT *, CASE WHEN kind = 'rect' AND (doc_id + elem_ix) % 3 > 0 THEN y1 - 10 * ((doc_id + elem_ix) % 3) + 5 END AS table_y0
    FROM ordered WHERE kind IN ('text', 'figure', 'rect'))
  WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY ord)),
numbered AS (
  SELECT *, CASE WHEN kind = 'rect' THEN sum(starts) OVER (PARTITION BY doc_id, page_no ORDER BY ord) - 1 END AS region,
         count(tbl) OVER (PARTITION BY doc_id, page_no) AS n_tables
  FROM (SELECT *, CASE WHEN kind = 'rect' AND (lowest IS NULL OR y1 <= lowest) AND (last_kind IS NULL OR last_kind <> 'rect')
                       THEN 1 ELSE 0 END AS starts FROM handled)),
regions AS (
  SELECT n.*, CASE WHEN kind = 'figure' THEN TRUE WHEN kind = 'rect' THEN starts = 1 AND region < n_tables
                   ELSE NOT EXISTS (SELECT 1 FROM numbered r WHERE r.doc_id = n.doc_id AND r.page_no = n.page_no AND r.kind = 'rect'
                                    AND r.ord < n.ord AND r.region < r.n_tables AND r.table_y0 < n.y1) END AS keep
  FROM numbered n)""",
    "multi_records": """multi_records AS (
  SELECT e.doc_id, e.page_no,
         coalesce(list(e.part_text ORDER BY e.ord) FILTER (WHERE r.keep), []) AS page_text,
         coalesce(list(e.fmt_kind ORDER BY e.ord) FILTER (WHERE r.keep), []) AS kinds,
         coalesce(list(TABLE_TEXT(pt.tables[CAST(r.region + 1 AS BIGINT)]) ORDER BY e.ord) FILTER (WHERE r.keep AND r.kind = 'rect'), []) AS text_from_tables,
         coalesce(list(CASE WHEN r.kind = 'rect' THEN TABLE_TEXT(pt.tables[CAST(r.region + 1 AS BIGINT)]) ELSE e.content END ORDER BY e.ord)
                  FILTER (WHERE r.keep), []) AS page_content
  FROM entries e LEFT JOIN regions r ON r.doc_id = e.doc_id AND r.page_no = e.page_no AND r.ord = e.ord
  LEFT JOIN page_tables pt ON pt.doc_id = e.doc_id AND pt.page_no = e.page_no
  GROUP BY e.doc_id, e.page_no)""",
    # lexical TF-IDF over passages, queries = benchmark items
    "tfidf": f"""p_tf AS (
  SELECT doc_id, line_no, term, count(*) AS tf FROM (
    SELECT doc_id, line_no, unnest({terms('passage')}) AS term FROM passages) GROUP BY ALL),
n_docs AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM passages),
p_df AS (SELECT term, count(*) AS df FROM p_tf GROUP BY term),
p_w AS (
  SELECT t.doc_id, t.line_no, t.term, t.tf * ln((n.n + 1) / (CAST(d.df AS DOUBLE) + 1)) AS weight
  FROM p_tf t JOIN p_df d USING (term) CROSS JOIN n_docs n),
p_post AS (
  SELECT doc_id, line_no, term, weight,
         weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id, line_no)) AS nweight
  FROM p_w WHERE weight > 0)""",
    "queries": """queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)""",
    "q_post": f"""q_tf AS (
  SELECT query_id, term, count(*) AS tf FROM (
    SELECT query_id, unnest({terms('query')}) AS term FROM queries) GROUP BY ALL),
q_w AS (
  SELECT q.query_id, q.term, q.tf * ln((n.n + 1) / (CAST(coalesce(d.df, 0) AS DOUBLE) + 1)) AS qweight
  FROM q_tf q LEFT JOIN p_df d USING (term) CROSS JOIN n_docs n),
q_post AS (
  SELECT query_id, term, qweight / qnorm AS nqweight FROM (
    SELECT *, sqrt(sum(qweight * qweight) OVER (PARTITION BY query_id)) AS qnorm FROM q_w) WHERE qnorm > 0)""",
    "sparse": """sparse AS (
  SELECT q.query_id, p.doc_id, p.line_no, sum(q.nqweight * p.nweight) AS score
  FROM q_post q JOIN p_post p USING (term) GROUP BY ALL)""",
    "hits": """hits AS (
  SELECT * FROM (
    SELECT query_id, doc_id, line_no, round(score, 6) AS score,
           row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id, line_no) AS rank
    FROM sparse WHERE score IS NOT NULL) WHERE rank <= 5)""",
    "hit_text": """hit_text AS (
  SELECT h.query_id, h.rank, h.doc_id, h.line_no, p.passage AS corpus_passage, h.score
  FROM hits h JOIN passages p USING (doc_id, line_no))""",
    "best": """best AS (
  SELECT query_id, corpus_passage AS best_match, score FROM hit_text WHERE rank = 1)""",
    "found": """found AS (
  SELECT b.query_id, m.doc_id, m.page_no, m.context
  FROM best b LEFT JOIN (
    SELECT * FROM (
      SELECT b.query_id, pc.doc_id, pc.page_no, pc.context,
             row_number() OVER (PARTITION BY b.query_id ORDER BY pc.doc_id, pc.page_no) AS rn
      FROM best b JOIN pages_clean pc ON contains(pc.page_lc, replace(lower(b.best_match), chr(962), chr(963))))
    WHERE rn = 1) m USING (query_id))""",
    # dense vectors: queries are the rows whose id is divisible by 20
    "dense": """ev AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL)),
dense AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CASE WHEN q.norm = 0 OR c.norm = 0 THEN 0.0
              ELSE list_dot_product(q.e, c.e) / (q.norm * c.norm) END AS score
  FROM ev q CROSS JOIN ev c WHERE q.vec_id % 20 = 0)""",
    # passages and queries as letter counts
    "letters": f"""q_vec AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM (SELECT query_id, {letters('query')} AS e FROM queries)),
p_vec AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM (SELECT doc_id, line_no, passage, {letters('passage')} AS e FROM passages)),
letter_hits AS (
  SELECT * FROM (
    SELECT query_id, corpus_passage, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, line_no) AS rank
    FROM (SELECT q.query_id, p.doc_id, p.line_no, p.passage AS corpus_passage,
                 round(CASE WHEN q.norm = 0 OR p.norm = 0 THEN 0.0
                            ELSE list_dot_product(q.e, p.e) / (q.norm * p.norm) END, 6) AS score
          FROM q_vec q CROSS JOIN p_vec p)) WHERE rank <= 5)""",
}

# dependencies between the views, in definition order
DEPS = {
    "doc_lines": [], "damaged_lines": ["doc_lines"], "passages": ["doc_lines"], "doc_pages": ["doc_lines"],
    "pages_clean": ["doc_pages"], "elements": ["doc_lines"], "marked": ["elements"],
    "page_tables": ["marked"], "entries": ["marked", "page_tables"], "page_records": ["entries"],
    "regions": ["marked"], "multi_records": ["regions", "entries", "page_tables"],
    "tfidf": ["passages"], "queries": [], "q_post": ["tfidf", "queries"], "sparse": ["tfidf", "q_post"],
    "hits": ["sparse"], "hit_text": ["hits", "passages"], "best": ["hit_text"],
    "found": ["best", "pages_clean"], "dense": [], "letters": ["passages", "queries"],
}


def table_text_sql(expr: str) -> str:
    """L6 in DuckDB: rows ``|a|b|`` joined by newlines, null cells ``None``."""
    row = ("'|' || array_to_string(list_transform(r, lambda c: coalesce(replace(c, chr(10), ' '), 'None')), '|') || '|'")
    return f"array_to_string(list_transform({expr}, lambda r: {row}), chr(10))"


def with_views(*names: str) -> str:
    """``WITH`` clause holding the named views and everything they need."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(CTE[n] for n in order)
    # TABLE_TEXT(x) is a macro-like placeholder used inside the views
    while "TABLE_TEXT(" in body:
        i = body.index("TABLE_TEXT(")
        j, depth = i + len("TABLE_TEXT("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(body[j], 0)
            j += 1
        inner = body[i + len("TABLE_TEXT("): j - 1]
        body = body[:i] + table_text_sql(inner) + body[j:]
    return "WITH " + body + "\n"
