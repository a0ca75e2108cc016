"""Text column expressions: substitution profiles, strip, blank-line test,
tokenising, damaged-token masking, stopword removal, context cut and prompt
rendering.

Every function takes and returns a ``Column`` made only of built-in Spark
expressions, so it runs inside whole-stage code generation and never enters a
Python worker."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Whitespace, as Python's ``str.isspace``/``str.strip``/``re`` ``\s`` see it.
# Built from that rule rather than listed: Java's ``\s`` and ``trim`` disagree
# with Python on U+001C..U+001F, NBSP and the other Unicode spaces.
# ---------------------------------------------------------------------------
WHITESPACE_CHARS: str = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def _java_class(chars: str, negate: bool = False) -> str:
    body = "".join(f"\\u{ord(c):04x}" for c in chars)
    return f"[{'^' if negate else ''}{body}]"


def re2_class(chars: str = WHITESPACE_CHARS, negate: bool = False) -> str:
    """The same class in RE2 syntax (used by the DuckDB oracles)."""
    body = "".join(f"\\x{{{ord(c):04x}}}" for c in chars)
    return f"[{'^' if negate else ''}{body}]"


WS_CLASS = _java_class(WHITESPACE_CHARS)
NON_WS_CLASS = _java_class(WHITESPACE_CHARS, negate=True)

# ---------------------------------------------------------------------------
# The substitution profiles, each an ordered list of
# (regular expression, replacement) pairs applied one after the other.
# They must equal the original pipeline's lists for identical output.
# ---------------------------------------------------------------------------

# Retrieval profile: applied to corpus lines before search and to whole pages
# before the context lookup.
RETRIEVAL_PROFILE: list[tuple[str, str]] = [
    (r"\n", ""),
    ("[*;@‎…`]", ""),
    (r"(´)", ""),
    (r"(\$)", "s"),
    (r"(<UNK>+)", ""),
    (r"(ñ+)", "n"),
    (r"(\")", ""),
    (r"(/)", " "),
    (r"(ş)", "s"),
    (r"(ă)", "a"),
    (r"(†)", ""),
    (r"(ŭ)", "u"),
    (r"(ŏ)", "o"),
    (r"(ō)", "o"),
    (r"(ī)", "i"),
    (r"(ç)", "c"),
    (r"(:+|-+)", " "),
    (r" +", " "),
]

# Corpus profile: the cleaning job's list (no newline pair; sentence
# punctuation, U+02BA and U+200E also deleted).
CORPUS_PROFILE: list[tuple[str, str]] = [
    ("[+*%?!'.;,@ʺ‎…`]", ""),
    (r"(´)", ""),
    (r"(\$)", "s"),
    (r"(<UNK>+)", ""),
    (r"(ñ+)", "n"),
    (r"(\")", ""),
    (r"(/)", " "),
    (r"(ş)", "s"),
    (r"(ă)", "a"),
    (r"(†)", ""),
    (r"(ŭ)", "u"),
    (r"(ŏ)", "o"),
    (r"(ō)", "o"),
    (r"(ī)", "i"),
    (r"(ç)", "c"),
    (r"(:+|-+)", " "),
    (r" +", " "),
]

# Slide profiles: German keeps umlauts, every other language spells them out.
SLIDE_PROFILE_DE: list[tuple[str, str]] = [
    (r"\r\n", ""),
    (r"\n", ""),
    (r"\t", ""),
]
SLIDE_PROFILE_OTHER: list[tuple[str, str]] = [
    (r"\r\n", ""),
    (r"\n", ""),
    (r"\t", ""),
    (r"ä", "ae"),
    (r"ö", "oe"),
    (r"ü", "ue"),
]

# Marker written in place of a token that contains U+FFFD.
UNKNOWN_TOKEN = "<UNK>"
REPLACEMENT_CHAR = "�"

# Prompt template of the answer step; ``{context}`` and ``{query}`` are filled
# per row.
DEFAULT_PROMPT_TEMPLATE = (
    "Use the following given economic context in order to answer concisely the given query at the end. "
    "If you do not know the answer, please simply say that you do not know it and do not try to make up an answer.\n"
    "{context}\n"
    "Query: {query}\n"
    "Answer:"
)

# Characters dropped from the start of a found page to form the context.
DEFAULT_CONTEXT_SKIP = 1500


# ---------------------------------------------------------------------------
# T1 and the profiles built on it
# ---------------------------------------------------------------------------
_SIMPLE_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_REGEX_META = set(".^$|?*+()[]{}\\")


def literal_chars(pattern: str) -> set[str] | None:
    """The characters a pattern matches when it is one literal character (a
    group around it, an escape) or a class of literal characters; else None."""
    p = pattern
    if len(p) >= 2 and p[0] == "(" and p[-1] == ")":
        p = p[1:-1]
    if len(p) > 2 and p[0] == "[" and p[-1] == "]":
        body = p[1:-1]
        if body.startswith("^") or any(c in body for c in "\\-[]"):
            return None
        return set(body)
    if len(p) == 2 and p[0] == "\\":
        if p[1] in _SIMPLE_ESCAPES:
            return {_SIMPLE_ESCAPES[p[1]]}
        return None if p[1].isalnum() else {p[1]}
    if len(p) == 1 and p not in _REGEX_META:
        return {p}
    return None


def plan_substitutions(pairs: Iterable[tuple[str, str]]) -> list[tuple[str, tuple]]:
    """Group an ordered substitution list into steps with the same result:
    a run of consecutive single-character rules (each character to at most
    one character) becomes one ``translate`` step, as long as no rule reads a
    character that an earlier rule of the run writes; every other rule stays
    a regular-expression replacement."""
    steps: list[tuple[str, tuple]] = []
    group: dict[str, str] = {}

    def flush() -> None:
        if group:
            mapped = [(c, r) for c, r in group.items() if r]
            deleted = [c for c, r in group.items() if not r]
            steps.append(("translate", ("".join(c for c, _ in mapped) + "".join(deleted),
                                        "".join(r for _, r in mapped))))
            group.clear()

    for pat, rep in pairs:
        chars = literal_chars(pat)
        if chars is None or len(rep) > 1:
            flush()
            steps.append(("regex", (pat, rep)))
            continue
        outputs = set(group.values()) - {""}
        if chars & outputs or chars & set(group):
            flush()
        for c in sorted(chars):
            group[c] = rep
    flush()
    return steps


def chain_sub(col: ColumnOrName, pairs: Iterable[tuple[str, str]]) -> Column:
    """Apply ``(regex, replacement)`` pairs in order, each replacing every
    match; later pairs see the output of earlier ones. Runs of independent
    single-character rules are applied together by one ``translate``
    (``plan_substitutions``), which gives the same string in fewer passes."""
    def step(c: Column, st: tuple[str, tuple]) -> Column:
        kind, (a, b) = st
        return F.translate(c, a, b) if kind == "translate" else F.regexp_replace(c, a, b)

    return reduce(step, plan_substitutions(pairs), _col(col))


def clean_retrieval(col: ColumnOrName) -> Column:
    return chain_sub(col, RETRIEVAL_PROFILE)


def clean_corpus_profile(col: ColumnOrName) -> Column:
    return chain_sub(col, CORPUS_PROFILE)


def slide_profile(lang: str) -> list[tuple[str, str]]:
    return SLIDE_PROFILE_DE if lang == "de" else SLIDE_PROFILE_OTHER


def clean_slide(col: ColumnOrName, lang: str = "de") -> Column:
    return chain_sub(col, slide_profile(lang))


# ---------------------------------------------------------------------------
# T6 strip, F1 blank test
# ---------------------------------------------------------------------------
def strip(col: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace, Python's definition."""
    return F.btrim(_col(col), F.lit(WHITESPACE_CHARS))


def is_not_blank(col: ColumnOrName) -> Column:
    """True when the string has at least one non-whitespace character."""
    return _col(col).rlike(NON_WS_CLASS)


# ---------------------------------------------------------------------------
# tokens
# ---------------------------------------------------------------------------
def tokens(col: ColumnOrName) -> Column:
    """Split on every single whitespace character; empty tokens are kept."""
    return F.split(_col(col), WS_CLASS, -1)


def has_damage(tok: Column) -> Column:
    return F.contains(tok, F.lit(REPLACEMENT_CHAR))


def mask_damaged(tok_array: ColumnOrName) -> Column:
    """Replace every token that contains U+FFFD by ``<UNK>``."""
    return F.transform(_col(tok_array), lambda t: F.when(has_damage(t), F.lit(UNKNOWN_TOKEN)).otherwise(t))


def remove_stopwords(tok_array: ColumnOrName, stopwords: Sequence[str] | Column | None) -> Column:
    """Drop tokens found in ``stopwords`` (exact case, order kept). Damaged
    tokens are exempt: they are masked, never removed. ``stopwords`` is a list
    of strings or an array column."""
    arr = _col(tok_array)
    if stopwords is None:
        return arr
    if isinstance(stopwords, Column):
        return F.filter(arr, lambda t: has_damage(t) | ~F.array_contains(stopwords, t))
    words = list(stopwords)  # a hash set in the row
    return F.filter(arr, lambda t: has_damage(t) | ~t.isin(words)) if words else arr


def rejoin(tok_array: ColumnOrName) -> Column:
    return F.array_join(_col(tok_array), " ")


def clean_tokens_line(line: ColumnOrName, stopwords: Sequence[str] | Column | None = None,
                      terminated: bool | Column = True) -> Column:
    """T7 -> T9 -> T8 -> T10 for one line as read from a file. A line read
    with its terminator ends in an empty token, hence a trailing space;
    ``terminated`` can be a column (a file's last line may have none)."""
    if isinstance(terminated, Column):
        text = F.concat(_col(line), F.when(terminated, F.lit("\n")).otherwise(F.lit("")))
    else:
        text = F.concat(_col(line), F.lit("\n")) if terminated else _col(line)
    return rejoin(mask_damaged(remove_stopwords(tokens(text), stopwords)))


# ---------------------------------------------------------------------------
# F2, T12, T13
# ---------------------------------------------------------------------------
def fold_case(col: ColumnOrName) -> Column:
    """Lower case for matching: a word-final sigma equals any other sigma."""
    return F.translate(F.lower(_col(col)), "\u03c2", "\u03c3")


def contains_ci(haystack: ColumnOrName, needle: ColumnOrName) -> Column:
    """Case-insensitive literal containment (no regular expression)."""
    return F.contains(fold_case(haystack), fold_case(needle))


def cut_context(col: ColumnOrName, skip: int = DEFAULT_CONTEXT_SKIP) -> Column:
    """Drop the first ``skip`` characters; shorter strings become empty."""
    c = _col(col)
    return F.substring(c, skip + 1, 2147483647)


def template_variables(template: str = DEFAULT_PROMPT_TEMPLATE) -> list[str]:
    """Names of the ``{placeholders}`` of a template, in order of appearance."""
    import string

    return [name for _, name, _, _ in string.Formatter().parse(template) if name]


def render_prompt(values: dict[str, ColumnOrName], template: str = DEFAULT_PROMPT_TEMPLATE) -> Column:
    """Fill ``{name}`` placeholders from columns; a null value gives a null
    prompt (no context found means no prompt)."""
    import string

    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(_col(values[name]).cast("string"))
    return F.concat(*parts)
