"""Language identification with a byte convolutional network.

A text's UTF-8 bytes (A-Z lower-cased) are cut into windows of ``WINDOW`` bytes
that cover the whole text. Each byte has an embedding; filters of several
widths run over a window, are max-pooled and rectified, and a softmax layer
gives the window's language probabilities. A document's probabilities are the
mean over its windows, weighted by their bytes.

Training is numpy (Adam, cross entropy) on the driver over a bounded sample of
labelled rows: at most ``docs_per_lang`` documents a language in expectation,
chosen by the hash of id and text, at most ``windows_per_doc`` windows of each,
and ``2 * docs_per_lang * languages`` rows in all. Only text and label are read.

For prediction the filters are folded into lookup tables over byte pairs, so a
filter of width 2, 3 or 4 costs one or two table rows per byte.

Defined results: null text and texts without a letter give ``und`` with score
0; a table without learnable rows gives ``und`` everywhere; null labels are not
learned from; repeated rows are predicted alike; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm._common import held_out, learnable, read_table, worker_cache

UNKNOWN = "und"
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 12
DOCS_PER_LANG = 800
WINDOWS_PER_DOC = 4
EPOCHS = 12
_LETTER = re.compile(r"[^\W\d_]")


def cut_windows(text: bytes, window: int = WINDOW) -> np.ndarray:
    """All windows of a text, the last one padded with blanks."""
    raw = text.lower()
    raw += b" " * (-len(raw) % window)
    return np.frombuffer(raw, np.uint8).reshape(-1, window)


class ByteCNN:
    """Weights of the network; ``fit`` trains, ``tables`` folds for prediction."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.emb = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.conv = [rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.emb, *self.conv, self.bias, self.out, self.out_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean weighted cross entropy for windows ``x``."""
        n, length = x.shape
        e = self.emb[x]
        pooled, where, cols = [], [], []
        for w, k in zip(WIDTHS, self.conv):
            c = np.concatenate([e[:, i:length - w + 1 + i] for i in range(w)], axis=2)
            z = c @ k
            a = z.argmax(axis=1)
            pooled.append(np.take_along_axis(z, a[:, None, :], 1)[:, 0])
            where.append(a)
            cols.append(c)
        h = np.concatenate(pooled, 1) + self.bias
        r = np.maximum(h, 0)
        logits = r @ self.out + self.out_bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = p
        g[np.arange(n), y] -= 1
        g *= (weight / n)[:, None]
        d_out, d_ob = r.T @ g, g.sum(0)
        gh = (g @ self.out.T) * (h > 0)
        d_emb, d_conv = np.zeros_like(self.emb), []
        rows = np.arange(n)[:, None]
        for i, (w, k) in enumerate(zip(WIDTHS, self.conv)):
            gi = gh[:, i * FILTERS:(i + 1) * FILTERS]
            picked = cols[i][rows, where[i]]  # n, FILTERS, w * EMBED
            d_conv.append(np.einsum("nf,nfc->cf", gi, picked).astype(np.float32))
            back = gi[:, :, None] * k.T[None]  # n, FILTERS, w * EMBED
            for j in range(w):
                b = x[rows, where[i] + j]
                part = back[:, :, j * EMBED:(j + 1) * EMBED].reshape(-1, EMBED)
                for d in range(EMBED):
                    d_emb[:, d] += np.bincount(b.ravel(), part[:, d], 256).astype(np.float32)
        return [d_emb, *d_conv, gh.sum(0), d_out, d_ob]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.004, seed: int = 11) -> "ByteCNN":
        rng = np.random.default_rng(seed)
        count = np.bincount(y, minlength=len(self.langs))
        weight = (len(y) / (len(self.langs) * np.maximum(count, 1)))[y].astype(np.float32)
        m = [np.zeros_like(p) for p in self.params()]
        v = [np.zeros_like(p) for p in self.params()]
        step = 0
        total = epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                at = order[i:i + batch]
                step += 1
                lr = rate * (1 - 0.95 * step / total)
                for p, g, mi, vi in zip(self.params(), self.gradients(x[at], y[at], weight[at]), m, v):
                    mi += 0.1 * (g - mi)
                    vi += 0.001 * (g * g - vi)
                    p -= lr * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.999 ** step)) + 1e-8)
        return self

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width, ``(offset, table)`` with a row for each byte pair
        (``first * 256 + second``) or, for an odd last place, each byte."""
        out = []
        for w, k in zip(WIDTHS, self.conv):
            one = [self.emb @ k[j * EMBED:(j + 1) * EMBED] for j in range(w)]
            parts = [(j, np.ascontiguousarray((one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS))) for j in range(0, w - 1, 2)]
            if w % 2:
                parts.append((w - 1, np.ascontiguousarray(one[-1])))
            out.append(parts)
        return out

    def window_probs(self, x: np.ndarray, tables=None, chunk: int = 32) -> np.ndarray:
        """Language probabilities of each window of ``x`` (uint8)."""
        tables = tables or self.tables()
        length = x.shape[1]
        h = np.empty((len(x), FILTERS * len(WIDTHS)), np.float32)
        for i in range(0, len(x), chunk):
            b = x[i:i + chunk]
            one = b.astype(np.intp)
            pair = one[:, :-1] * 256 + one[:, 1:]
            for j, (w, parts) in enumerate(zip(WIDTHS, tables)):
                n = length - w + 1
                z = None
                for at, t in parts:
                    got = t.take((pair if len(t) == 65536 else one)[:, at:at + n], axis=0)
                    z = got if z is None else np.add(z, got, out=z)
                h[i:i + chunk, j * FILTERS:(j + 1) * FILTERS] = z.max(axis=1)
        logits = np.maximum(h + self.bias, 0) @ self.out + self.out_bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def predict(self, texts: list[str | None], tables=None) -> list[tuple[str, float]]:
        """``(language, score)`` of whole texts."""
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        own = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        group: list[int] = []
        size = 0
        for pos, i in enumerate(own):
            group.append(i)
            size += len(texts[i])
            if size < 1 << 20 and pos + 1 < len(own):
                continue
            raw = [texts[g].encode() for g in group]
            wins = [cut_windows(r) for r in raw]
            p = self.window_probs(np.concatenate(wins), tables)
            last = np.cumsum([len(w) for w in wins])
            weight = np.full(len(p), WINDOW, np.float64)
            weight[last - 1] = [len(r) - WINDOW * (len(w) - 1) for r, w in zip(raw, wins)]
            sums = np.add.reduceat(p * weight[:, None], np.concatenate(([0], last[:-1])))
            mean = sums / sums.sum(1, keepdims=True)
            for g, m in zip(group, mean):
                best = int(m.argmax())
                out[g] = (self.langs[best], float(min(1.0, m[best])))
            group, size = [], 0
        return out

    def digest(self) -> str:
        return hashlib.sha256(b"".join(p.tobytes() for p in self.params()) + repr(self.langs).encode()).hexdigest()


def training_windows(docs: DataFrame, text_col: str, lang_col: str, id_col: str, docs_per_lang: int,
                     windows_per_doc: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The bounded sample: languages, windows and label numbers."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int(min(1.0, docs_per_lang / counts[k]) * 1_000_000)))])
    h = F.xxhash64(F.lit("language sample"), F.col(id_col), F.col(text_col))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                w = cut_windows(t.encode()) if _LETTER.search(t) else np.zeros((0, WINDOW), np.uint8)
                at = np.unique(np.linspace(0, max(len(w) - 2, 0), windows_per_doc).astype(int)) if len(w) else []
                out.append(w[at].tobytes() if len(w) else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), b.column(2)], names=["lang", "w", "h"])

    some = rows.withColumn("__h", h).where(F.pmod(F.col("__h"), F.lit(1_000_000)) < F.element_at(share, F.col(lang_col)))
    got = (some.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t"), F.col("__h").alias("h"))
           .mapInArrow(cut, "lang string, w binary, h bigint").orderBy("h", "lang", "w").limit(2 * docs_per_lang * len(langs)).toArrow())
    number = {k: i for i, k in enumerate(langs)}
    x, y = [np.zeros((0, WINDOW), np.uint8)], []
    for lang, w in zip(got.column("lang").to_pylist(), got.column("w").to_pylist()):
        wins = np.frombuffer(w, np.uint8).reshape(-1, WINDOW)
        x.append(wins)
        y += [number[lang]] * len(wins)
    return langs, np.concatenate(x), np.array(y, np.int64)


def train_language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> ByteCNN:
    """Fit on ``docs`` (already restricted to the rows to learn from)."""
    langs, x, y = training_windows(docs, text_col, lang_col, id_col, docs_per_lang, windows_per_doc)
    model = ByteCNN(langs)
    return model.fit(x, y) if len(x) else ByteCNN([])


def identify(docs: DataFrame, model: ByteCNN, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score appended (columns of
    these names are replaced)."""
    docs = docs.drop(lang_out, score_out)
    state = (model.langs, model.params())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, params = state
        net = ByteCNN.__new__(ByteCNN)
        net.langs, net.emb, net.conv = langs, params[0], params[1:1 + len(WIDTHS)]
        net.bias, net.out, net.out_bias = params[1 + len(WIDTHS):]
        home = worker_cache("language_tables")
        key = net.digest()
        if key not in home:
            home.clear()
            home[key] = net.tables()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                got = net.predict(part.column(part.num_columns - 1).to_pylist(), home[key])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    names=[f"c{k}" for k in range(part.num_columns + 1)])

    cols = docs.columns
    sent = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], F.col(f"`{text_col}`").cast("string").alias(f"c{len(cols)}"))
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(cols)]
                        + [StructField(f"c{len(cols)}", StringType()), StructField(f"c{len(cols) + 1}", DoubleType())])
    return sent.mapInArrow(run, schema).toDF(*cols, lang_out, score_out)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: doc_id, held_out, lang_pred, score."""
    docs = read_table(spark, sf_dir, "documents")
    model = train_language_id(docs.where(learnable(F.col("doc_id"))))
    got = identify(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
