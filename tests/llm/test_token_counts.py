"""Prefix counts against the library: every prefix encoded on its own."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sifter.llm import token_counts as tc

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "a  <|endoftext|> b<|endoftext|><|endoftext|> x", "x's 're we're they'll  'll\n'll \n 've", "  \n\n  x\n\n y\t\tz  ",
       "a" * 300 + " " + "=" * 150 + "-" * 40, "日本語 é 🙂 x՘࢏౜    y\U00033479\U00010ec5", "'''s 's ''re 'r 'l 'lx !'s 1's 's\x85's \x1c's x\x1c\x1cy",
       "   ", "\n", " 're\r\n're  \n're", "<|endoftext|>", "  <|endof  <|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(VOCAB)
    return lambda texts: [len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def test_every_prefix_equals_the_library(library, spark, small_dir):
    rng = random.Random(5)
    alphabet = "ab '\nsretl1!é 　日<|>"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(200)]
    table = tc.PrefixTable(VOCAB, cache_units=50)
    taken = [r.text[:300] for r in spark.read.parquet(f"{small_dir}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    for text in ODD + made + taken:
        assert table.counts(text).tolist() == library([text[:i] for i in range(len(text) + 1)]), text


def test_pairs_that_may_not_meet():
    """A pair may stand side by side exactly if encoding the two together keeps them apart."""
    table = tc.PrefixTable(VOCAB)
    words = [None] * len(table.made)
    for t in range(len(words)):
        words[t] = bytes([t]) if t < 256 else words[table.left[t]] + words[table.right[t]]
    rng = random.Random(7)

    def merge(word):  # the plain rule: lowest rank first, leftmost among equals
        row = list(word)
        while True:
            ranked = [(table.rank[p], i) for i, p in enumerate(zip(row, row[1:])) if p in table.rank]
            if not ranked:
                return row
            _, i = min(ranked)
            row[i:i + 2] = [number[words[row[i]] + words[row[i + 1]]]]

    number = {w: t for t, w in enumerate(words)}
    for _ in range(3000):
        a, b = (rng.choice((rng.randrange(256, 1500), rng.randrange(len(words)))) for _ in "ab")
        if merge(words[a]) == [a] and merge(words[b]) == [b]:
            assert table.may_follow(a, b) == (merge(words[a] + words[b]) == [a, b])


def test_columns_nulls_and_budgets(spark, library):
    long = "word another 123 " * 6000
    docs = spark.createDataFrame([(1, "one two  three", "x"), (None, None, None), (1, "one two  three", "x"), (2, long, "y")],
                                 "doc_id long, text string, prefix_tokens string")
    got = tc.prefix_counts(docs, VOCAB)
    assert got.columns == ["doc_id", "text", "prefix_tokens"]
    rows = got.select("doc_id", "text", "prefix_tokens", tc.total_tokens(F.col("prefix_tokens")).alias("n"),
                      tc.longest_within(F.col("prefix_tokens"), 3).alias("cut"), tc.truncate(F.col("text"), F.col("prefix_tokens"), 3).alias("head"),
                      tc.tokens_of_prefix(F.col("prefix_tokens"), 7).alias("seven")).collect()
    assert len(rows) == 4
    for r in rows:
        text = r.text or ""
        assert r.n == library([text])[0] and r.prefix_tokens[0] == 0 and len(r.prefix_tokens) == len(text) + 1
        want = max(i for i in range(len(text[:60]) + 1) if library([text[:i]])[0] <= 3)
        assert r.cut == want and r.head == text[:want] and r.seven == library([text[:7]])[0]
    assert tc.prefix_counts(docs.limit(0), VOCAB).collect() == []


def test_registered_query_equals_the_library(spark, small_dir, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = tc.op11_token_counts(spark, small_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    want = dict(zip(docs, library(list(docs.values()))))
    for r in rows:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), want[r.doc_id], want[r.doc_id] > 512)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        tc.PrefixTable(public_tokenizers.path("word_bpe_49k.json"))
