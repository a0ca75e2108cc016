"""Extension points for pluggable models: encoder (V1), pair scorer (V8) and
answer generator (M1). Each is a factory returning a callable; it is built
once per Python worker (cached across tasks while the worker is reused) and
fed Arrow batches through ``mapInPandas``. The models themselves are the
caller's; the deterministic test models below need no download."""

from __future__ import annotations

import hashlib
import pickle
import re
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WHITESPACE_CHARS

Encoder = Callable[[list[str]], "np.ndarray"]
PairScorer = Callable[[list[str], list[str]], Sequence[float]]
Generator = Callable[[list[str]], Sequence[str]]

def _pickled(factory: Callable[[], object]) -> bytes:
    return cloudpickle.dumps(factory)


def _model(factory: bytes) -> object:
    """One model per worker process and factory. Functions travel by value, so
    a global of this module would be new in every task: the models hang on
    ``sys``, under the digest of the pickled factory (two closures of one
    function keep their own model)."""
    models = sys.__dict__.setdefault("_sifter_models", {})
    key = hashlib.sha256(factory).digest()
    if key not in models:
        models[key] = pickle.loads(factory)()
    return models[key]


def embed(df: DataFrame, text_col: str, encoder_factory: Callable[[], Encoder],
          out_col: str = "embedding") -> DataFrame:
    """V1: add ``out_col ARRAY<FLOAT>`` from a batch encoder."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.FloatType()))])
    factory = _pickled(encoder_factory)

    def run(batches):
        enc = _model(factory)
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            vecs = np.asarray(enc(texts), dtype=np.float32) if texts else np.zeros((0, 0), np.float32)
            yield pa.RecordBatch.from_arrays([*batch.columns, vector_lists(vecs)], names=schema.names)

    return df.mapInArrow(run, schema)


def vector_lists(vectors: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list array of 32-bit floats."""
    n, width = vectors.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(vectors, np.float32).ravel()))


def rerank(hits: DataFrame, scorer_factory: Callable[[], PairScorer], query_col: str = "query",
           passage_col: str = "corpus_passage", out_col: str = "cross_score", reorder: bool = False,
           group: str = "query_id") -> DataFrame:
    """V8: score each (query, hit) pair and add ``out_col``. Rows keep the
    cosine order unless ``reorder``, which re-ranks by the new score."""
    schema = T.StructType(hits.schema.fields + [T.StructField(out_col, T.DoubleType())])
    factory = _pickled(scorer_factory)

    def run(batches):
        scorer = _model(factory)
        for pdf in batches:
            qs = pdf[query_col].fillna("").tolist()
            ps = pdf[passage_col].fillna("").tolist()
            pdf[out_col] = np.asarray(scorer(qs, ps), dtype=np.float64) if len(pdf) else np.zeros(0)
            yield pdf

    out = hits.mapInPandas(run, schema)
    if reorder:
        w = Window.partitionBy(group).orderBy(F.col(out_col).desc(), F.col("rank").asc())
        out = out.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return out


def generate(df: DataFrame, prompt_col: str, generator_factory: Callable[[], Generator],
             out_col: str = "answer") -> DataFrame:
    """M1: answer every non-null prompt with the generator."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType())])
    factory = _pickled(generator_factory)

    def run(batches):
        gen = _model(factory)
        for pdf in batches:
            mask = pdf[prompt_col].notna()
            answers = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
            if mask.any():
                answers[mask] = list(gen(pdf.loc[mask, prompt_col].tolist()))
            pdf[out_col] = answers
            yield pdf

    return df.mapInPandas(run, schema)


# ---------------------------------------------------------------------------
# Deterministic stand-in models for tests and for runs without a model
# ---------------------------------------------------------------------------
_WS_SPLIT = re.compile("[" + re.escape(WHITESPACE_CHARS) + "]")


def _token_set(text: str) -> set[str]:
    return {t for t in _WS_SPLIT.split(text.lower()) if t}


def jaccard_scorer() -> PairScorer:
    """Token-set Jaccard of lower-cased whitespace tokens."""
    def score(qs: list[str], ps: list[str]) -> list[float]:
        out = []
        for q, p in zip(qs, ps):
            a, b = _token_set(q), _token_set(p)
            u = len(a | b)
            out.append(len(a & b) / u if u else 0.0)
        return out
    return score


def hashing_encoder(dim: int = 64) -> Encoder:
    """Bag of hashed lower-cased tokens, L2-normalised (a model-free encoder)."""
    import zlib

    def enc(texts: list[str]) -> np.ndarray:
        m = np.zeros((len(texts), dim), dtype=np.float64)
        for i, t in enumerate(texts):
            for tok in _token_set(t):
                m[i, zlib.crc32(tok.encode("utf-8")) % dim] += 1.0
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1.0, n)
    return enc


def letter_encoder() -> Encoder:
    """Counts of the letters a-z, either case."""
    code = np.full(256, 26, np.int64)  # no other byte of UTF-8 is a letter's
    for i in range(26):
        code[ord("a") + i] = code[ord("A") + i] = i

    def enc(texts: list[str]) -> np.ndarray:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        flat = code[np.frombuffer(b"".join(raw), np.uint8)]
        flat += 27 * np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        return np.bincount(flat, minlength=27 * len(raw)).reshape(len(raw), 27)[:, :26].astype(np.float64)
    return enc


def echo_generator() -> Generator:
    """Answers with the last line of the prompt's query."""
    def gen(prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            q = [ln for ln in p.split("\n") if ln.startswith("Query: ")]
            out.append(q[-1][len("Query: "):] if q else "")
        return out
    return gen
