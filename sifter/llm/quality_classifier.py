"""Quality classifier: histogram gradient-boosted trees over document statistics.

``STATISTICS`` are computed from the whole text: shares of byte classes, word
and line shapes, repetition. Trees are grown level by level on binned
statistics (quantile bins of the sample) from histograms of gradients and
hessians, all in numpy, and flattened into arrays: every tree is complete, so
the node reached after ``DEPTH`` steps is an index computation and a batch is
traversed for all trees at once.

Training takes a bounded sample of labelled rows: the ``MAX_ROWS`` with the
smallest hash of the id among those the caller lets it learn from.

Defined results: null text counts as empty; a missing label is not learned
from; without labelled rows every score is 0.5; ids labelled more than once
count once per label; repeated rows are scored alike; extra columns pass
through unless they have the outputs' names, which are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from sifter.llm._common import held_out, learnable, read_table

MAX_ROWS = 8000
BINS = 64
DEPTH = 4
TREES = 120
RATE = 0.15
STATISTICS = ["bytes", "words", "word_length", "long_words", "short_words", "lower", "upper", "digits", "blanks", "newlines",
              "sentence_marks", "commas", "symbols", "calls", "quotes", "high_bytes", "entropy", "distinct_words",
              "top_word", "repeated_pairs", "lines", "words_per_line", "repeated_lines", "lines_ended", "upper_words", "marked_words"]

_CLASSES = np.zeros((256, 10), np.float64)
for _i, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n",
                             b".;:", b",", b"#*$%&|<>@_=+{}[]\\^~", b"!?", b"\"'()"]):
    _CLASSES[list(_chars), _i] = 1


def statistics(text: bytes) -> list[float]:
    """The statistics of one UTF-8 text, in the order of ``STATISTICS``."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts / max(n, 1)
    lower, upper, digits, blanks, newlines, marks, commas, symbols, calls, quotes = (share @ _CLASSES).tolist()
    p = share[share > 0]
    entropy = float(-(p * np.log2(p)).sum()) if n else 0.0
    words = text.split()
    m = len(words)
    sizes = np.fromiter(map(len, words), np.int64, m)
    top = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = len(lines)
    return [np.log1p(n), np.log1p(m), float(sizes.mean()) if m else 0.0, float((sizes > 12).mean()) if m else 0.0,
            float((sizes < 4).mean()) if m else 0.0, lower, upper, digits, blanks, newlines, marks, commas, symbols, calls, quotes,
            float(share[128:].sum()), entropy, len(top) / max(m, 1), max(top.values(), default=0) / max(m, 1),
            1 - pairs / max(m - 1, 1) if m > 1 else 0.0, np.log1p(k), m / max(k, 1), 1 - len(set(lines)) / max(k, 1),
            sum(x.rstrip()[-1:] in b".!?" for x in lines) / max(k, 1),
            sum(w.isupper() for w in words) / max(m, 1), sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / max(m, 1)]


class BoostedTrees:
    """Complete binary trees in arrays ``feature``, ``threshold`` (trees, inner
    nodes) and ``leaf`` (trees, 2 ** depth); a row goes right if its value is
    greater than the threshold."""

    def __init__(self, prior: float = 0.0, depth: int = DEPTH):
        self.prior, self.depth = prior, depth
        self.feature = np.zeros((0, 2 ** depth - 1), np.int64)
        self.threshold = np.zeros((0, 2 ** depth - 1))
        self.leaf = np.zeros((0, 2 ** depth))

    def margin(self, x: np.ndarray) -> np.ndarray:
        if len(self.feature) == 0 or len(x) == 0:
            return np.full(len(x), self.prior)
        tree = np.arange(len(self.feature))[None, :]
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return self.prior + self.leaf[tree, node - (2 ** self.depth - 1)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS,
            l2: float = 1.0, least: int = 10) -> "BoostedTrees":
        if len(y) == 0:
            return cls()
        mean = np.clip(y.mean(), 0.001, 0.999)
        model = cls(float(np.log(mean / (1 - mean))), depth)
        n, f = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)  # value <= edge b: bin <= b
        flat = binned + np.arange(f)[None, :] * bins
        margin = np.full(n, model.prior)
        feature, threshold, leaf = [], [], []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            feat, thr = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
            for d in range(depth):
                k, first = 2 ** d, 2 ** d - 1
                at = ((node - first)[:, None] * (f * bins) + flat).ravel()
                size = k * f * bins
                hg, hh, hn = (np.bincount(at, np.repeat(v, f), size).reshape(k, f, bins).cumsum(2) for v in (g, h, np.ones(n)))
                tg, th, tn = hg[:, :, -1:], hh[:, :, -1:], hn[:, :, -1:]
                gain = hg ** 2 / (hh + l2) + (tg - hg) ** 2 / (th - hh + l2) - tg ** 2 / (th + l2)
                gain = np.where((hn >= least) & (tn - hn >= least), gain, -1.0)
                best = gain.reshape(k, -1).argmax(1)
                value = gain.reshape(k, -1).max(1)
                for i in range(k):
                    j, b = divmod(int(best[i]), bins)
                    if value[i] > 1e-6 and b < len(edges[j]):
                        feat[first + i], thr[first + i] = j, edges[j][b]
                node = 2 * node + 1 + (x[np.arange(n), feat[node]] > thr[node])
            own = node - (2 ** depth - 1)
            values = -rate * np.bincount(own, g, 2 ** depth) / (np.bincount(own, h, 2 ** depth) + l2)
            margin += values[own]
            feature.append(feat)
            threshold.append(thr)
            leaf.append(values)
        model.feature, model.threshold, model.leaf = np.array(feature), np.array(threshold), np.array(leaf)
        return model


def _batch_statistics(column: pa.Array) -> np.ndarray:
    rows = [statistics(t.as_py() or b"") for t in column.cast(pa.binary())]
    return np.array(rows, np.float32).astype(np.float64) if rows else np.zeros((0, len(STATISTICS)))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the bounded sample."""
    picked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y"))
              .orderBy(F.xxhash64(F.lit("quality sample"), F.col("__id")), "__id", "__y").limit(max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _batch_statistics(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())), b.column(1)], names=["x", "y"])

    # at most max_rows ids: small enough to send to every task; repeated documents of an id are limited with them
    rows = docs.join(F.broadcast(picked), F.col(id_col) == F.col("__id")).select(F.col(text_col).cast("string").alias("t"), F.col("__y").alias("y"))
    got = rows.mapInArrow(run, StructType([StructField("x", ArrayType(FloatType())), StructField("y", DoubleType())])).limit(2 * max_rows).toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, len(STATISTICS))
    y = got.column("y").to_numpy()
    order = np.lexsort((*x.T, y))  # the same model whatever the order of arrival
    return x[order], y[order]


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  max_rows: int = MAX_ROWS) -> BoostedTrees:
    return BoostedTrees.fit(*training_rows(docs, labels, id_col, text_col, label_col, max_rows))


def score_quality(docs: DataFrame, model: BoostedTrees, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score appended."""
    docs_out = docs.drop(out_col)
    cols = docs_out.columns
    state = (model.prior, model.depth, model.feature, model.threshold, model.leaf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = BoostedTrees(state[0], state[1])
        trees.feature, trees.threshold, trees.leaf = state[2:]
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                score = trees.score(_batch_statistics(part.column(part.num_columns - 1)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score, pa.float64())], names=[f"c{k}" for k in range(part.num_columns)])

    sent = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], F.col(f"`{text_col}`").cast("string").alias(f"c{len(cols)}"))
    schema = StructType([StructField(f"c{i}", docs_out.schema[c].dataType) for i, c in enumerate(cols)] + [StructField(f"c{len(cols)}", DoubleType())])
    return sent.mapInArrow(run, schema).toDF(*cols, out_col)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: doc_id, held_out, score, predicted."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(learnable(F.col("doc_id")))
    got = score_quality(docs, train_quality(docs, labels))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
