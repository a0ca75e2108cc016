"""Quality rules, line first, as DataFrame expressions only.

Every line with a word is judged alone:

* punctuation: it ends in a sentence mark (closing quotes and brackets may
  follow), or it has a sentence mark inside and ``CUT_LINE_WORDS`` words (prose
  cut off by a line break, a number or an address); at most a tenth as many
  symbols ``#*$%&|<>`` as words and at most three doubled ``!`` or ``?`` per
  ten words
* navigation: no three separators (``|``, ``>``, angle quotes, middle dot)
  with blanks around them, and not a short line of menu words
* boilerplate: none of the phrases of ``BOILERPLATE``

Failing lines are removed. A document is rejected if it fails the base rules of
the contract (fewer than 20 words, or over 30 of 100 words in repeated 8-word
windows) or if it lost more than ``MAX_LOSS`` of its words' characters.

Each rule is evaluated inside the row: no shuffle. Repeated windows are found
by 64-bit hashes of the windows, compared by sorting only in the documents that
have a repeat at all.

Defined results: null text counts as empty (base_failed, not kept, no text);
repeated rows are judged alike; extra columns pass through unless they have the
names of the outputs, which are replaced; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm._common import read_table

MAX_LOSS = 0.5
CUT_LINE_WORDS = 10
WINDOW = 8
BLANK = r"[\x09-\x0D\x20]+"
WORD = r"[^\x09-\x0D\x20]+"
SYMBOL = r"[#*$%&|<>]"
END_MARK = r"[.!?\x{2026}:;][\"'\x{201D}\x{00BB})\]]*$"
INNER_MARK = r"[.!?\x{2026}][\x09-\x0D\x20]"
DOUBLED = r"[!?]{2,}"
SEPARATOR = r"[\x09-\x0D\x20][|>\x{00BB}\x{00B7}][\x09-\x0D\x20]"
_MENU_WORDS = (r"(?:home|menu|next|previous|back|login|log in|sign in|sign up|register|search|contact us|contact|about us|about|"
               r"help|faq|sitemap|site map|share|print|top|read more|more|skip to content)")
#: Longer words stand first, so no repetition ever has to give anything back: the
#: groups are possessive and a line of any length is matched in one sweep.
MENU = rf"(?i)^{_MENU_WORDS}(?:[\x09-\x0D\x20]*+[|>/]?[\x09-\x0D\x20]*+{_MENU_WORDS})*+[.]?$"
BOILERPLATE = (r"(?i)(lorem ipsum|all rights reserved|terms of (use|service)|privacy policy|cookie policy|uses? cookies|"
               r"enable javascript|subscribe to|newsletter|click here|released under the|licensed under)")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def repeated_window_words(words: Column, size: int = WINDOW) -> Column:
    """Number of words that lie in a window of ``size`` words found twice or more."""

    def covered(h: Column) -> Column:
        def from_sorted(s: Column) -> Column:
            same = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                            lambda k: (F.get(s, k)["h"].eqNullSafe(F.get(s, k - 1)["h"])) | (F.get(s, k)["h"].eqNullSafe(F.get(s, k + 1)["h"])))
            starts = F.sort_array(F.transform(same, lambda k: F.get(s, k)["i"]))
            return _let(starts, lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - x, F.lit(size)))), F.lit(0), lambda a, x: a + x))

        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                .otherwise(_let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), from_sorted)))

    def of_words(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))
        return F.when(F.size(w) <= size, F.lit(0)).otherwise(_let(hashes, covered))

    return _let(words, of_words)


def _rules(line: Column, words: Column) -> Column:
    """Per line: true if it passes every rule."""
    trimmed = F.btrim(line, F.lit("\t\n\x0b\x0c\r "))

    def judged(x: Column) -> Column:
        ends = x.rlike(END_MARK) | ((words >= CUT_LINE_WORDS) & x.rlike(INNER_MARK))
        calm = (F.regexp_count(x, F.lit(SYMBOL)) * 10 <= words) & (F.regexp_count(x, F.lit(DOUBLED)) * 10 <= 3 * words)
        nav = (F.regexp_count(x, F.lit(SEPARATOR)) >= 3) | ((words <= 12) & x.rlike(MENU))
        return ends & calm & ~nav & ~x.rlike(BOILERPLATE)

    return _let(trimmed, judged)


def line_quality(docs: DataFrame, text_col: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, kept_chars (of the words in lines that pass), base_failed,
    kept and clean_text (the lines that pass; null if the document goes)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    outputs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_chars", "base_failed", "kept", "clean_text"]
    cols = [F.col(f"`{c}`") for c in docs.columns if c not in outputs]
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    judged = F.transform(lines, lambda x: F.struct(x.alias("line"), F.length(F.regexp_replace(x, BLANK, "")).alias("chars"),
                                                   F.regexp_count(x, F.lit(WORD)).alias("n")))
    good = _let(judged, lambda js: F.filter(js, lambda j: _rules(j["line"], j["n"])))
    base = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_window_words(w).cast("long").alias("n_repeat_words")))
    dup = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    one = docs.select(*cols, base.alias("__base"), F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"), dup.alias("n_dup_lines"),
                      _let(good, lambda g: F.struct(
                          F.aggregate(g, F.lit(0).cast("long"), lambda a, j: a + j["chars"]).alias("chars"),
                          F.array_join(F.transform(g, lambda j: j["line"]), "\n").alias("text"))).alias("__good"))
    n, repeat, chars = F.col("__base.n_words"), F.col("__base.n_repeat_words"), F.col("__base.word_chars")
    failed = (n < 20) | (100 * repeat > 30 * n)
    kept = ~failed & (F.col("__good.chars") >= (1 - max_loss) * chars)
    return one.select(*cols, n.alias("n_words"), chars.alias("word_chars"), "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"),
                      F.col("__good.chars").alias("kept_chars"), failed.alias("base_failed"), kept.alias("kept"),
                      F.when(kept, F.col("__good.text")).alias("clean_text"))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept; and kept_chars."""
    return line_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "clean_text")


_SQL = {k: v.replace("'", "''") for k, v in {"WORD": WORD, "BLANK": BLANK, "SYMBOL": SYMBOL, "END": END_MARK, "INNER": INNER_MARK,
                                             "DOUBLED": DOUBLED, "SEP": SEPARATOR, "MENU": MENU.replace("*+", "*"), "BOILER": BOILERPLATE}.items()}

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '{_SQL["BLANK"]}'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS s
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) > {WINDOW})),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n
        FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM rep) GROUP BY rid),
l AS (SELECT rid, line, regexp_replace(line, '^[\\x09-\\x0D\\x20]+|[\\x09-\\x0D\\x20]+$', '', 'g') AS x,
             len(regexp_extract_all(line, '{_SQL["WORD"]}')) AS n,
             length(regexp_replace(line, '{_SQL["BLANK"]}', '', 'g')) AS chars
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{_SQL["WORD"]}')),
j AS (SELECT rid, chars, line,
             (regexp_matches(x, '{_SQL["END"]}') OR (n >= {CUT_LINE_WORDS} AND regexp_matches(x, '{_SQL["INNER"]}')))
             AND len(regexp_extract_all(x, '{_SQL["SYMBOL"]}')) * 10 <= n
             AND len(regexp_extract_all(x, '{_SQL["DOUBLED"]}')) * 10 <= 3 * n
             AND NOT (len(regexp_extract_all(x, '{_SQL["SEP"]}')) >= 3 OR (n <= 12 AND regexp_matches(x, '{_SQL["MENU"]}')))
             AND NOT regexp_matches(x, '{_SQL["BOILER"]}') AS good
      FROM l),
g AS (SELECT rid, count(*) - count(DISTINCT line) AS dups, sum(CASE WHEN good THEN chars ELSE 0 END) AS kept_chars FROM j GROUP BY rid),
b AS (SELECT d.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '{_SQL["SYMBOL"]}')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
      FROM d JOIN w ON d.rid = w.rid LEFT JOIN g ON d.rid = g.rid LEFT JOIN cov ON d.rid = cov.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, kept_chars,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND kept_chars >= {1 - MAX_LOSS} * word_chars AS kept
FROM b
"""
