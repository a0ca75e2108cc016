"""LM scoring by masked pseudo-likelihood.

Every token of a text is predicted from the tokens on both sides of it; the
summed conditional log-probabilities score the document. The network sees two
tokens to the left and two to the right: an embedding per place, summed,
squashed, then a two-step softmax (the token's class, the token in its class).

Tokens are blank-separated words, A-Z lower-cased. The most frequent words of
the whole corpus have an id of their own; any other word goes by one of the hash
buckets, the place beyond an end of the text by its own token. Ids grow with the
number of distinct words, from ``LEAST`` to ``MOST``; a sixteenth of them are
buckets. The class of a token goes by its corpus frequency, and the output biases
start from the corpus counts, bucket counts included.

A word that shares a bucket has P(bucket | context) times P(word | bucket). The
second factor is its corpus count over the bucket's, smoothed by ``SMOOTH`` a
word; the words that the corpus does not have share one word's smoothing. The
counts stay on Spark: texts are dealt into pieces of about ``PIECE`` tokens, each
with a list of its bucketed words; the lists are joined with the word counts by
shuffle, and each piece's counts meet its texts again where these are scored.

What is gathered follows the corpus: word counts of every document, and
gradient steps on every position of every document, each in one of the
``ROUNDS``. Each partition trains its own copy; the copies, weighted by their positions, are
averaged on Spark block by block after every round; only the averaged network
(half a megabyte to two) comes to the driver.

Defined results: null and word-less texts have no tokens, log-probability 0 and
a null mean; repeated rows score alike; an empty corpus gives an untrained
network and no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.llm._common import numbered_words, read_table, text_chunks
from sifter.session import ensure_checkpoint_dir, materialise

#: Ids of a network, powers of two; one more for every DISTINCT distinct words.
LEAST, MOST = 1024, 4096
DISTINCT = 64
CLASSES = 32
EMBED = 24
SIDE = 2
#: Positions are dealt into TRAIN_EVERY classes, the classes to the rounds.
TRAIN_EVERY = 2
ROUNDS = 2
#: Positions of a step: the larger where a group of texts has enough for several.
BATCH, LARGE_BATCH = 512, 4096
RATE = 0.15
#: Tokens of a piece, and words in a row of its list.
PIECE, LISTED = 1 << 21, 8192
#: Added to the count of every word of a bucket, and once for all unseen ones.
SMOOTH = 0.5
#: Text whose words are counted at once, in bytes.
COUNTED = 16 << 20
#: Rows whose logits are held at once.
RUN = 1024
#: Floats per row when networks are averaged.
BLOCK = 8192


class WindowNet:
    """The network over token ids 0 .. size - 1, dealt to classes by id: token
    ``t`` is number ``t % width`` of class ``t // width``. The last id pads."""

    def __init__(self, size: int, classes: int | None = None, embed: int = EMBED, seed: int = 3):
        classes = classes or max(CLASSES, 1 << (size.bit_length() // 2))
        rng = np.random.default_rng(seed)
        self.size, self.classes, self.width = size, classes, -(-size // classes)
        self.emb = rng.normal(0, 0.1, (2 * SIDE, size, embed)).astype(np.float32)
        self.bias = np.zeros(embed, np.float32)
        self.top = rng.normal(0, 0.1, (embed, classes)).astype(np.float32)
        self.top_bias = np.zeros(classes, np.float32)
        self.low = rng.normal(0, 0.1, (classes, embed, self.width)).astype(np.float32)
        self.low_bias = np.zeros((classes, self.width), np.float32)

    def set_counts(self, counts: np.ndarray) -> "WindowNet":
        """Output biases from the corpus counts of each id."""
        c = np.full(self.classes * self.width, 1e-4)
        c[:self.size] = counts + 0.5
        c = c.reshape(self.classes, self.width)
        self.top_bias = np.log(c.sum(1) / c.sum()).astype(np.float32)
        self.low_bias = np.log(c / c.sum(1, keepdims=True)).astype(np.float32)
        return self

    def params(self) -> list[np.ndarray]:
        return [self.emb, self.bias, self.top, self.top_bias, self.low, self.low_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params()])

    def load(self, flat: np.ndarray) -> "WindowNet":
        at = 0
        for name, p in zip(("emb", "bias", "top", "top_bias", "low", "low_bias"), self.params()):
            setattr(self, name, flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return self

    def hidden(self, context: np.ndarray) -> np.ndarray:
        z = self.bias + self.emb[0].take(context[0], axis=0)
        for i in range(1, 2 * SIDE):
            z += self.emb[i].take(context[i], axis=0)
        return np.tanh(z, out=z)

    def by_class(self, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Order of targets by class, and ``(class, first, last + 1)`` of each in it."""
        cls = (target // self.width).astype(np.uint16)
        ends = np.cumsum(np.bincount(cls, minlength=self.classes)).tolist()
        return np.argsort(cls, kind="stable"), [(c, a, z) for c, a, z in zip(range(self.classes), [0, *ends], ends) if z > a]

    def _shifted(self, w: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, bool]:
        """Output weights above their bias, as a row of values and a one meets
        them. The bias is less the greatest value that a row can get, which
        drops out of the softmax; if a row's own greatest value could be so far
        below that its exponentials vanish, it is not, and the answer is no."""
        reach = np.abs(w).sum(-2)  # squashed values are within -1 and 1
        most, least = (bias + reach).max(-1, keepdims=True), (bias - reach).max(-1, keepdims=True)
        close = bool((most - least < 80).all())
        return np.concatenate((w, np.expand_dims(bias - most if close else bias, -2)), axis=-2), close

    def _logits(self, h: np.ndarray, parts: list[tuple[int, int, int]], first: int, top: tuple[np.ndarray, bool], low: tuple[np.ndarray, bool]) -> tuple[np.ndarray, np.ndarray]:
        """Shifted logits of the classes, and of the tokens of each row's class,
        for the rows from ``first`` on, which ``parts`` name."""
        a, b = h @ top[0], np.empty((len(h), self.width), np.float32)
        for c, lo, hi in parts:
            np.matmul(h[lo - first:hi - first], low[0][c], out=b[lo - first:hi - first])
        for x, close in ((a, top[1]), (b, low[1])):
            if not close:
                x -= x.max(1, keepdims=True)
        return a, b

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target given its context (places, n)."""
        order, parts = self.by_class(target)
        h, t = _with_one(self.hidden(context[:, order])), target[order]
        top, low = self._shifted(self.top, self.top_bias), self._shifted(self.low, self.low_bias)
        got = np.zeros(len(t), np.float32)
        for first, last, some in _runs(parts):
            rows = np.arange(last - first)
            for x, at in zip(self._logits(h[first:last], some, first, top, low), (t[first:last] // self.width, t[first:last] % self.width)):
                got[first:last] += x[rows, at]
                np.exp(x, out=x)
                got[first:last] -= np.log(x @ np.ones(x.shape[1], np.float32))
        out = np.empty_like(got)
        out[order] = got
        return out

    def gradients(self, context: np.ndarray, target: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Sums over a batch of the gradients of minus the log-probability:
        those of ``params()`` after the embeddings, then the rows of the squashed
        sum's input and the contexts they belong to."""
        order, parts = self.by_class(target)
        context, target = context[:, order], target[order]
        h = _with_one(self.hidden(context))
        width = h.shape[1] - 1
        top, low = self._shifted(self.top, self.top_bias), self._shifted(self.low, self.low_bias)
        d_top, d_low = np.zeros((width + 1, self.classes), np.float32), np.zeros((self.classes, width + 1, self.width), np.float32)
        dz = np.empty((len(h), width), np.float32)
        for first, last, some in _runs(parts):
            # with exponentials e of sum s, the gradient (e / s - target) is (e - s * target) / s: the narrow side is divided
            own, t, rows = h[first:last], target[first:last], np.arange(last - first)
            p, q = self._logits(own, some, first, top, low)
            np.exp(p, out=p)
            s = p @ np.ones(self.classes, np.float32)
            p[rows, t // self.width] -= s
            part = 1 / s[:, None]
            d_top += (own * part).T @ p
            dh = (p @ self.top.T) * part
            np.exp(q, out=q)
            s = q @ np.ones(self.width, np.float32)
            q[rows, t % self.width] -= s
            part = 1 / s[:, None]
            divided = own * part
            back = np.empty_like(dh)
            for c, lo, hi in some:
                np.matmul(divided[lo - first:hi - first].T, q[lo - first:hi - first], out=d_low[c])
                np.matmul(q[lo - first:hi - first], self.low[c].T, out=back[lo - first:hi - first])
            back *= part
            dh += back
            own = own[:, :width]
            np.multiply(dh, 1 - own * own, out=dz[first:last])
        return [dz.sum(0), d_top[:width], d_top[width], d_low[:, :width], d_low[:, width]], dz, context

    def step(self, context: np.ndarray, target: np.ndarray, memory: list[np.ndarray], rate: float) -> None:
        """One Adagrad step on a batch."""
        n = len(target)
        grads, dz, context = self.gradients(context, target)
        for p, g, m in zip(self.params()[1:], grads, memory[1:]):
            g = g / np.float32(n)
            m += g * g
            g *= np.float32(rate)
            g /= np.sqrt(m + np.float32(1e-8))
            p -= g
        # only the rows that the batch names, of all places at once
        at = (context + np.arange(2 * SIDE)[:, None] * self.size).ravel().astype(np.uint32 if 2 * SIDE * self.size > 1 << 16 else np.uint16)
        by = np.argsort(at, kind="stable")
        at = at[by]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        seen = at[first].astype(np.intp)
        dz *= np.float32(1 / n)
        g = np.add.reduceat(dz.take(by % n, axis=0), first, axis=0)
        m = memory[0].reshape(-1, dz.shape[1])
        own = g * g
        own += m.take(seen, axis=0)
        m[seen] = own
        own += np.float32(1e-8)
        np.sqrt(own, out=own)
        g *= np.float32(rate)
        g /= own
        rows = self.emb.reshape(-1, dz.shape[1])
        rows[seen] = rows.take(seen, axis=0) - g


def _runs(parts: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """Parts in runs of ``RUN`` rows or one part: their logits stay in the cache."""
    run: list[tuple[int, int, int]] = []
    for part in parts:
        run.append(part)
        if part[2] - run[0][1] >= RUN:
            yield run[0][1], part[2], run
            run = []
    if run:
        yield run[0][1], run[-1][2], run


def _with_one(h: np.ndarray) -> np.ndarray:
    return np.concatenate((h, np.ones((len(h), 1), np.float32)), axis=1)


def contexts(ids: np.ndarray, lengths: np.ndarray, pad: int) -> np.ndarray:
    """``(2 * SIDE, n)`` ids around each position of texts that follow each
    other in ``ids``; places beyond a text's ends hold ``pad``."""
    n = len(ids)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    out = np.full((2 * SIDE, n), pad, np.int64)
    for i, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        a, z = max(0, -d), min(n, n - d)
        if z > a:
            out[i, a:z] = np.where(doc[a + d:z + d] == doc[a:z], ids[a + d:z + d], pad)
    return out


def word_counts(docs: DataFrame, text_col: str = "text", most: int = COUNTED) -> DataFrame:
    """``(word binary, n)`` over every text; counted per ``most`` bytes of text first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            words, at, _ = numbered_words(pa.concat_arrays(held))
            held.clear()
            return pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(np.bincount(at, minlength=len(words)).astype(np.int64))], names=["word", "n"])

        held, size = [], 0
        for b in batches:
            for first, n in text_chunks(b.column(0), most):
                held.append(b.column(0).slice(first, n))
                size += pc.sum(pc.binary_length(held[-1])).as_py() or 0
                if size >= most:
                    yield rows()
                    size = 0
        if held:
            yield rows()

    return docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary(dict):
    """Ids of the most frequent words. ``words`` and ``buckets`` are the numbers
    of ids, ``rare`` the logarithm of each bucket's smoothed count."""

    words: int
    buckets: int
    rare: np.ndarray


def vocabulary(docs: DataFrame, text_col: str = "text", words: int | None = None, buckets: int | None = None,
               counted: DataFrame | None = None) -> tuple[Vocabulary, np.ndarray]:
    """Ids of the most frequent words and the corpus counts of every id."""
    import zlib

    counted = materialise(word_counts(docs, text_col), "words") if counted is None else counted
    size = LEAST
    if words is None:
        distinct = counted.count()
        while size < MOST and size * DISTINCT < distinct:
            size *= 2
    words, buckets = words or size - size // 16, buckets or size // 16 - 1
    top = counted.orderBy(F.col("n").desc(), "word").limit(words).collect()
    vocab = Vocabulary((bytes(r.word), i) for i, r in enumerate(top))
    counts, kinds = np.zeros(words + buckets + 1), np.zeros(buckets)
    counts[:len(top)] = [r.n for r in top]
    for r in counted.groupBy((F.crc32("word") % buckets).cast("int").alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("d")).collect():
        counts[words + r.b], kinds[r.b] = r.n, r.d
    for w, i in vocab.items():
        b = zlib.crc32(w) % buckets
        counts[words + b] -= counts[i]
        kinds[b] -= 1
    counts = np.maximum(counts, 0)
    vocab.words, vocab.buckets = words, buckets
    vocab.rare = np.log(counts[words:words + buckets] + SMOOTH * (kinds + 1))
    return vocab, counts


def token_pieces(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """``(piece, id, ids binary, rare binary, first, words)``. A text's row has
    its 16-bit token ids and, for those that are buckets, the 32-bit numbers of
    the words in the piece's list. The other rows, without ids, are that list:
    ``words`` from number ``first`` on. To be written before it is used."""
    words, buckets = vocab.words, vocab.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        def numbering() -> defaultdict:
            """Ids of the vocabulary; other words get the next number as they come."""
            return defaultdict(count(words).__next__, vocab)

        names = ["piece", "id", "ids", "rare", "first", "words"]
        context = TaskContext.get()
        key, size, kind = (context.partitionId() if context else 0) << 24, 0, None
        listed, home, numbers = [], np.zeros(0, np.uint32), numbering()

        def binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
            offsets = np.concatenate(([0], ends)) * data.itemsize
            return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())

        def words_listed() -> pa.RecordBatch:
            firsts = range(0, len(listed), LISTED)
            n = len(firsts)
            return pa.RecordBatch.from_arrays(
                [pa.array([key] * n, pa.int64()), pa.nulls(n, kind), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array(firsts, pa.int32()),
                 pa.array([listed[i:i + LISTED] for i in firsts], pa.list_(pa.binary()))], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 512):
                b = batch.slice(i, 512)
                distinct, at, ends = numbered_words(b.column(1))
                got = np.fromiter(map(numbers.__getitem__, distinct.to_numpy(zero_copy_only=False).tolist()), np.uint32, len(distinct))[at]
                # the words that are new stand last, in the order of their numbers
                fresh = list(islice(reversed(numbers), len(numbers) - len(vocab) - len(listed)))[::-1]
                listed += fresh
                hashes = np.fromiter(map(zlib.crc32, fresh), np.uint32, len(fresh))
                home = np.concatenate((home, hashes % np.uint32(buckets) + np.uint32(words)))
                at = got >= words
                rare = got[at] - np.uint32(words)
                got[at] = home[rare]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, key)), b.column(0), binary(got.astype(np.uint16), ends),
                     binary(rare, np.concatenate(([0], np.cumsum(at)))[ends]), pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.list_(pa.binary()))],
                    names=names)
                size += len(got)
                if size >= piece:
                    yield words_listed()
                    key, size = key + 1, 0
                    listed, home, numbers = [], np.zeros(0, np.uint32), numbering()
        if listed:
            yield words_listed()

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return slim.mapInArrow(run, f"piece bigint, id {slim.schema['id'].dataType.simpleString()}, ids binary, rare binary, first int, words array<binary>")


def token_ids(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids binary)``: 16-bit token ids of every text."""
    return token_pieces(docs, vocab, id_col, text_col).where("ids is not null").select("id", "ids")


def _windows(column: pa.Array, pad: int, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, lengths, contexts)`` of groups of whole texts."""
    group: list[bytes] = []
    size = 0

    def made():
        ids = np.frombuffer(b"".join(group), np.uint16).astype(np.int64)
        lengths = np.array([len(x) // 2 for x in group])
        return ids, lengths, contexts(ids, lengths, pad)

    for x in column.to_pylist():
        group.append(x)
        size += len(x) // 2
        if size >= most:
            yield made()
            group, size = [], 0
    if group:
        yield made()


def picked(ids: np.ndarray, turn: int, every: int = TRAIN_EVERY, rounds: int = ROUNDS) -> np.ndarray:
    """Positions that round ``turn`` trains on, mixed: of the ``every`` classes
    of positions those that are ``turn`` modulo ``rounds``, so that each
    position comes in exactly one round."""
    mix = (np.arange(len(ids), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    pick = np.flatnonzero((mix >> np.uint64(40)) % np.uint64(every) % np.uint64(rounds) == np.uint64(turn))
    return pick[np.argsort(mix[pick] >> np.uint64(20))]


def train(tokens: DataFrame, counts: np.ndarray, every: int = TRAIN_EVERY, rounds: int = ROUNDS) -> WindowNet:
    """Averaged local training over all partitions of ``tokens`` (durable)."""
    size = len(counts)
    net = WindowNet(size).set_counts(counts)
    for turn in range(rounds):
        start = net.flat()

        def run(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            own = WindowNet(size).load(start)
            memory = [np.zeros_like(p) for p in own.params()]
            seen = 0
            for b in batches:
                for ids, _, ctx in _windows(b.column(0), size - 1):
                    pick = picked(ids, turn, every, rounds)
                    batch = LARGE_BATCH if len(pick) >= 8 * LARGE_BATCH else BATCH
                    for i in range(0, len(pick), batch):
                        at = pick[i:i + batch]
                        own.step(ctx[:, at], ids[at], memory, RATE / (1 + turn))
                    seen += len(pick)
            if seen:
                flat = own.flat().astype(np.float64) * seen
                parts = [flat[i:i + BLOCK] for i in range(0, len(flat), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()),
                                                  pa.array([x.astype(np.float32).tobytes() for x in parts], pa.binary())], names=["block", "n", "w"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for b in batches:
                for k, n, w in zip(*(b.column(i).to_pylist() for i in range(3))):
                    x = np.frombuffer(w, np.float32).astype(np.float64)
                    if k in sums:
                        sums[k][0] += n
                        sums[k][1] += x
                    else:
                        sums[k] = [n, x]
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v[0] for v in sums.values()], pa.int64()),
                                                  pa.array([v[1].tobytes() for v in sums.values()], pa.binary())], names=["block", "n", "w"])

        local = tokens.select("ids").mapInArrow(run, "block int, n bigint, w binary")
        got = local.repartition("block").mapInArrow(add, "block int, n bigint, w binary").collect()
        if got:
            got.sort(key=lambda r: r.block)
            net = WindowNet(size).load(np.concatenate([np.frombuffer(r.w, np.float64) / r.n for r in got]))
    return net


def _scores(own: WindowNet, texts: pa.Array, more=None) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and log-probability of each text; ``more(ids)`` is added by token."""
    n, total = [np.zeros(0, np.int64)], [np.zeros(0)]
    for ids, lengths, ctx in _windows(texts, own.size - 1):
        lp = np.zeros(len(ids))
        for i in range(0, len(ids), 1 << 15):
            lp[i:i + (1 << 15)] = own.log_probs(ctx[:, i:i + (1 << 15)], ids[i:i + (1 << 15)])
        if more:
            lp += more(ids)
        sums = np.concatenate(([0.0], np.cumsum(lp)))
        ends = np.cumsum(lengths)
        n.append(lengths)
        total.append(sums[ends] - sums[ends - lengths])
    return np.concatenate(n), np.concatenate(total)


def _scored(ids: pa.Array, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    mean = pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0)
    return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(total, pa.float64()), mean], names=["id", "n_tokens", "log_prob", "mean_log_prob"])


def score(tokens: DataFrame, net: WindowNet) -> DataFrame:
    """``(id, n_tokens, log_prob, mean_log_prob)`` per row, of token ids: a
    bucketed word counts as its bucket."""
    size, flat = net.size, net.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WindowNet(size).load(flat)
        for b in batches:
            yield _scored(b.column(0), *_scores(own, b.column(1)))

    kind = tokens.schema["id"].dataType.simpleString()
    return tokens.select("id", "ids").mapInArrow(run, f"id {kind}, n_tokens bigint, log_prob double, mean_log_prob double")


def score_words(pieces: DataFrame, net: WindowNet, vocab: Vocabulary, counted: DataFrame) -> DataFrame:
    """``(id, n_tokens, log_prob, mean_log_prob)`` per text of ``pieces``
    (durable), of words: a bucketed word has its share of the bucket."""
    size, flat, words, rare = net.size, net.flat(), vocab.words, vocab.rare
    kind = pieces.schema["id"].dataType.simpleString()
    listed = pieces.where("ids is null").select("piece", "first", F.posexplode("words").alias("k", "word"))
    known = counted.select(F.col("word").alias("word_"), "n")
    listed = listed.join(known, F.col("word") == F.col("word_"), "left").select(
        "piece", F.lit(None).cast(kind).alias("id"), F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("rare"),
        (F.col("first") + F.col("k")).alias("at"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    texts = pieces.where("ids is not null").select("piece", "id", "ids", "rare", F.lit(None).cast("int").alias("at"), F.lit(None).cast("bigint").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WindowNet(size).load(flat)
        piece, places, found, log_n = None, [], [], np.zeros(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, texts = batch.column(0).to_numpy(), batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(keys) != 0) | np.diff(texts)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if keys[a] != piece:
                    piece, places, found, log_n = keys[a], [], [], np.zeros(0)
                if not texts[a]:  # a piece's list comes before its texts
                    places.append(batch.column(4).slice(a, z - a).to_numpy())
                    found.append(batch.column(5).slice(a, z - a).to_numpy())
                    continue
                if found:
                    log_n = np.zeros(sum(map(len, found)))
                    log_n[np.concatenate(places)] = np.log(np.concatenate(found) + SMOOTH)
                    places, found = [], []
                for i in range(a, z, 1024):
                    b = batch.slice(i, min(1024, z - i))
                    number, used = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint32), 0

                    def share(ids: np.ndarray) -> np.ndarray:
                        nonlocal used
                        out, at = np.zeros(len(ids)), np.flatnonzero(ids >= words)
                        out[at] = log_n[number[used:used + len(at)]] - rare[ids[at] - words]
                        used += len(at)
                        return out

                    yield _scored(b.column(1), *_scores(own, b.column(2), share))

    # one number to sort by: lists before texts in each piece
    both = listed.unionByName(texts).repartition("piece").sortWithinPartitions(F.col("piece") * 2 + F.col("at").isNull().cast("int"))
    return both.mapInArrow(run, f"id {kind}, n_tokens bigint, log_prob double, mean_log_prob double")


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, log_prob, mean_log_prob)`` per row of ``docs``, by a
    network trained on ``docs``."""
    counted = materialise(word_counts(docs, text_col), "words")
    vocab, counts = vocabulary(docs, text_col, counted=counted)
    path = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/sifter-tables/token-ids-{uuid.uuid4().hex}"
    token_pieces(docs, vocab, id_col, text_col).write.option("compression", "zstd").parquet(path)
    pieces = docs.sparkSession.read.parquet(path)
    return score_words(pieces, train(pieces.where("ids is not null"), counts), vocab, counted)


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, log_prob, mean_log_prob."""
    return pseudo_likelihood(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
