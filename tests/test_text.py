"""Text functions on edge strings, against plain-Python brute force (the
original pipeline's own operations: sequential re.sub, str.strip, re.split)."""

import re

import pytest
from pyspark.sql import functions as F

from sifter.functions import tables as tf
from sifter.functions import text as tx

EDGE = ["a\nb", "x**;@‎…`y", "<UNK>>> z <UNK", 'ñññ "q" a/b $5 ::-- c', "  a   b ", "",
        "\xa0x\xa0", "a\r\nb", "\x1cq", "é -:- x", '<UN"K>', "ä ö ü ß\tx", "´†ŭŏōīçşă", "a b　"]


def py_chain(s, pairs):
    for p, r in pairs:
        s = re.sub(p, r, s)
    return s


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def collect(df):
    return [r[0] for r in df.orderBy("i").select("out").collect()]


@pytest.mark.parametrize("profile", ["RETRIEVAL_PROFILE", "CORPUS_PROFILE", "SLIDE_PROFILE_DE", "SLIDE_PROFILE_OTHER"])
def test_profiles_match_python(spark, profile):
    pairs = getattr(tx, profile)
    got = collect(frame(spark, EDGE).withColumn("out", tx.chain_sub("s", pairs)))
    assert got == [py_chain(s, pairs) for s in EDGE]


def test_fused_plan_equals_sequential_on_random_strings():
    import random

    alphabet = "ab \n\r\t*;@‎…`´$<UNK>ñ\"/şă†ŭŏōīç:-+%?!'.,ʺäöüns"
    rnd = random.Random(7)
    for pairs in (tx.RETRIEVAL_PROFILE, tx.CORPUS_PROFILE, tx.SLIDE_PROFILE_OTHER):
        for _ in range(3000):
            s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 24)))
            out = s
            for kind, (a, b) in tx.plan_substitutions(pairs):
                if kind == "regex":
                    out = re.sub(a, b, out)
                else:
                    m = {}
                    for i, c in enumerate(a):
                        m.setdefault(c, b[i] if i < len(b) else "")
                    out = "".join(m.get(ch, ch) for ch in out)
            assert out == py_chain(s, pairs), s


def test_strip_and_blank_match_python(spark):
    df = frame(spark, EDGE + ["\x1c\x1d ", " "])
    got = collect(df.withColumn("out", tx.strip("s")))
    assert got == [s.strip() for s in EDGE + ["\x1c\x1d ", " "]]
    blank = collect(df.withColumn("out", tx.is_not_blank("s")))
    assert blank == [not (s + "\n").isspace() for s in EDGE + ["\x1c\x1d ", " "]]


def test_retrieval_line_cleaning_matches_python(spark):
    got = collect(frame(spark, EDGE).withColumn("out", tx.clean_retrieval(tx.strip("s"))))
    assert got == [py_chain(s.strip(), tx.RETRIEVAL_PROFILE) for s in EDGE]


def test_tokens_mask_stopwords_rejoin_match_python(spark):
    sw = ["the", "of", "a"]
    lines = ["the cat\tof é", "a  b", "", "x�y the", " of"]

    def py(line):
        words = []
        for w in re.split(r"\s", line + "\n"):
            if "�" in w:
                words.append("<UNK>")
            elif w not in sw and not w.isspace():
                words.append(w)
        return " ".join(words)

    got = collect(frame(spark, lines).withColumn("out", tx.clean_tokens_line("s", sw)))
    assert got == [py(s) for s in lines]
    toks = collect(frame(spark, lines).withColumn("out", tx.tokens("s")))
    assert [list(t) for t in toks] == [re.split(r"\s", s) for s in lines]


def test_cut_context_lengths(spark):
    values = ["x" * n for n in (0, 1499, 1500, 1501, 3000)]
    got = collect(frame(spark, values).withColumn("out", tx.cut_context("s")))
    assert got == [s[1500:] for s in values]


def test_render_prompt_matches_format(spark):
    assert tx.template_variables() == ["context", "query"]
    df = spark.createDataFrame([(0, "ctx {x}", "why?")], "i int, c string, q string")
    got = collect(df.withColumn("out", tx.render_prompt({"context": "c", "query": "q"})))
    assert got == [tx.DEFAULT_PROMPT_TEMPLATE.format(context="ctx {x}", query="why?")]
    null_ctx = spark.createDataFrame([(0, None, "q")], "i int, c string, q string")
    assert collect(null_ctx.withColumn("out", tx.render_prompt({"context": "c", "query": "q"}))) == [None]


def test_contains_ci_is_literal(spark):
    df = spark.createDataFrame([(0, "A.b*C", "a.B*c"), (1, "axbc", "a.b")], "i int, h string, n string")
    assert collect(df.withColumn("out", tx.contains_ci("h", "n"))) == [True, False]


def table_to_text_py(table):
    out = ""
    for row in table:
        cells = [c.replace("\n", " ") if c is not None and "\n" in c else "None" if c is None else c for c in row]
        out += "|" + "|".join(cells) + "|" + "\n"
    return out[:-1]


def test_table_to_text_edge_cases(spark):
    tables = [[["a\nb", None], ["c", ""]], [], [[]], [["x"]]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tables)], "i int, t array<array<string>>")
    got = collect(df.withColumn("out", tf.table_to_text("t")))
    assert got == [table_to_text_py(t) for t in tables]
    assert got[0] == "|a b|None|\n|c||"
    nth = df.select("i", tf.nth_table(F.array("t"), 1).alias("out"))
    assert collect(nth) == [None] * len(tables)


def test_stopword_table_in_row_and_by_join(spark):
    from sifter.plans.jobs import clean_tokens_with_stopword_table

    rows = [(1, 0, "the cat the", True), (1, 1, "the of", False), (1, 2, "", True), (1, 3, "no listed word", False),
            (2, 0, "th\ufffde the  The", True), (2, 1, None, True)]
    lines = spark.createDataFrame(rows, "doc_id long, line_no long, line string, ended boolean")
    words = spark.createDataFrame([("the",), ("of",), ("the",), (None,)], "word string")
    want = {(r.doc_id, r.line_no): r.line for r in lines.select(
        "doc_id", "line_no", tx.clean_tokens_line("line", ["the", "of"], F.col("ended")).alias("line")).collect()}
    for most in (0, 10):
        got = clean_tokens_with_stopword_table(lines, words, terminated=F.col("ended"), max_inline=most).collect()
        assert {(r.doc_id, r.line_no): r.line for r in got} == want and len(got) == len(rows)
    assert want[(1, 0)] == "cat " and want[(2, 0)] == "<UNK>  The "
