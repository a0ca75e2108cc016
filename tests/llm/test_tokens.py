"""Token store and SentencePiece codec against the libraries, text by text."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from sifter.llm import sentencepiece_codec as sp
from sifter.llm import token_store as ts

VOCAB = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  a  b ", "▁x▁ y", "\n\n\t", "日本語 é ", "a" * 50 + "  ", "<s> </s> <0x0A>", "🙂 x", " ", "x ▁", "  \n a",
       "a.b. ,x a,. A'S. <|ENDOFTEXT|> <|endoftext|>. É. ÉA. İx. İ. \x01 a\x01b \x01\x01 c", " ..  x..,", "Σας. ΟΔΟΣ. K.", "w " * 3000]


def test_word_encoder_equals_library(spark, small_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    tok = Tokenizer.from_file(VOCAB)
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    enc = ts.WordEncoder(VOCAB, cache_words=2000)
    assert [x for i in range(0, len(texts), 7) for x in enc.encode(texts[i:i + 7])] == want


def test_word_encoder_forms_of_a_word(monkeypatch):
    letters = [chr(c) for c in (*range(0x20, 0x250), *range(0x300, 0x310), *range(0x370, 0x470), 0x1E96, 0x212A, 0x212B, 0x0DF)]
    texts = [f for c in letters for f in (c, f"a{c}.", f"{c}A%%%", f"J{c},", f"t{c}a x")] + ["J̌ H̱. T̈ W̊, Y̊", "it'S. 's' <|endoftext|>. a<|endoftext|>b A<|ENDOFTEXT|>."]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(VOCAB).encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(ts, "CHUNK_BYTES", 300)
    enc = ts.WordEncoder(VOCAB, cache_words=50)
    assert enc.encode(texts) == want and enc.encode(texts[::-1]) == want[::-1]
    enc.letters = None  # without the way for letters
    assert ts.WordEncoder.encode(enc, texts) == want
    enc.by_word = False
    assert enc.encode(texts) == want


def test_word_encoder_meets_the_letters_of_a_word_once():
    enc, met = ts.WordEncoder(VOCAB), []
    for tok in ("tok", "letters"):
        class Seen:
            def __init__(self, own):
                self.own = own

            def encode_batch_fast(self, texts, **more):
                met.extend(w for t in texts for w in t.split() if w != "\x01")
                return self.own.encode_batch_fast(texts, **more)

        setattr(enc, tok, Seen(getattr(enc, tok)))
    text = "Größe größe. größe%%% GRÖSSE größe!! Größe,%%% größe, x%%%"
    enc.encode([text, text.upper(), "", text + " größe"])
    assert sorted(met) == sorted({"größe", "grösse", "x", ".", "%%%", "!!", ",%%%", ","})


def test_token_store_chunks_keep_rows_and_empty_texts(spark, monkeypatch):
    monkeypatch.setattr(ts, "CHUNK_BYTES", 20)
    texts = [None, "", "a b", "one two three four five six seven", None, " ", "x", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["i", "t"]).slice(1)
    for end, tail in ((1, [1]), (7, [7])):
        got = [r for b in ts.encode_ids(None, VOCAB, 1, end)(iter([batch, batch.slice(0, 0), batch.slice(4)])) for r in zip(*(b.column(k).to_pylist() for k in (0, 1)))]
        tok = Tokenizer.from_file(VOCAB)
        want = [(i, tok.encode(texts[i] or "", add_special_tokens=False).ids + tail) for i in [*range(1, 8), 5, 6, 7]]
        assert got == want


def test_token_store_round_trip(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(900, None, ), (901, ""), (None, "x"), (901, "y")], "doc_id long, text string")
    out = str(tmp_path / "store")
    ts.write_token_store(docs.unionByName(extra), out, VOCAB)
    rows = {}
    for r in docs.unionByName(extra).collect():
        rows.setdefault(r.doc_id, []).append(r.text or "")
    got = sorted(ts.token_index(ts.read_token_store(spark, out)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([k for k, v in rows.items() for _ in v], key=lambda k: (k is not None, k))
    tok = Tokenizer.from_file(VOCAB)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        crcs = {zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for t in rows[r.doc_id]}
        assert r.ids_crc32 in crcs
    assert ts.lookup(spark, out, [900]).collect()[0].ids == [1]


def test_sentencepiece_parity_and_decoding(spark, small_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    ref = sentencepiece.SentencePieceProcessor(model_file=sp.model_path())
    c = sp.SentencePieceCodec(sp.model_path(), cache_units=500)
    got = [np.frombuffer(x, "<u4").tolist() for i in range(0, len(texts), 9) for x in c.encode(texts[i:i + 9])]
    assert got == ref.encode(texts) and c.mismatches == 0
    assert c.decode(got) == [t.replace("▁", " ") for t in texts]


def test_sentencepiece_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "q"), (None, None, None), (1, "a b", "q")], "doc_id long, text string, ids string")
    out = sp.round_trip(docs, sp.model_path())
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "ids_crc32", "round_trip", "n_corrected"]
    assert all(r.round_trip for r in rows) and sorted(r.n_tokens for r in rows)[0] == 0
    back = sp.decode(sp.encode(docs, sp.model_path()), sp.model_path()).collect()
    assert [r.decoded for r in back] == [r.text or "" for r in back]
    assert sp.round_trip(docs.limit(0), sp.model_path()).count() == 0


def test_sentencepiece_corrections_are_counted():
    c = sp.SentencePieceCodec(sp.model_path(), cache_units=4)
    library = c.ref

    class Other:
        """A library that gives one word other ids."""

        def encode(self, texts, num_threads=1):
            return [ids + [7] if "odd" in t else ids for t, ids in zip(texts, library.encode(texts, num_threads=num_threads))]

    c.ref = Other()
    texts = ["an odd word and an odd one", "plain words only", "", "odd"]
    for _ in range(3):  # also from the cache, and after it was cut
        raw, counts = c.encode_counted(texts)
        assert counts == [2, 0, 0, 1]
        assert np.frombuffer(raw[3], "<u4").tolist() == library.encode("odd") + [7]
    c.units = False
    assert c.encode_counted(texts)[1] == [1, 0, 0, 1]
