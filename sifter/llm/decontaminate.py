"""Benchmark decontamination with SimHash windows.

Words (Unicode letters and digits, lower-cased) of every document are hashed
once. For each benchmark item of ``L`` words, every window of ``L`` words of a
document is a candidate:

1. A window that reaches the similarity shares at least
   ``2s / (1 + s)`` of its five-word shingles with the item (both have the same
   number of shingles), so windows with fewer shingles that occur in any item
   are left out; this drops no match.
2. The remaining windows get a 64-bit SimHash of their shingles. The items'
   fingerprints are indexed in eight 8-bit blocks; a pair within ``RADIUS``
   bits differs in at most ``RADIUS // 8`` bits in some block, so the windows
   are looked up in every block at that distance, which guarantees all pairs
   within the radius; the distance is then checked.
3. Candidates are verified by exact weighted similarity of their shingles (sum
   of the smaller over sum of the larger multiplicities) on the words.

``RADIUS`` is set so that the fingerprints of texts of similarity 0.8 are beyond
it with a probability below 1e-5 (9.7 bits differ on average, deviation 2.9).

A document of fewer words than the item is one window, the whole of it. If its
shingles can reach the similarity and enough of them occur in any item, it is
compared exactly with every item of that length, without fingerprints.

Items of fewer than five words have one shingle, the whole item. The items are
a query set: they are read in blocks of at most ``block_bytes`` of text, and
each block is matched against all documents in one pass without a shuffle of
documents; no window or fingerprint leaves its task.

Defined results: null or word-less texts match nothing; null or word-less items
are ignored; repeated rows match alike; empty tables give no matches; extra
columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField, StructType)

from sifter.llm._common import bitmap_hits, read_table, worker_cache

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 20_000
_WORD = re.compile(r"[^\W_]+")
_BITMAP = 22
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class WordHashes(dict):
    """Hash by word; words not seen before are hashed as they are asked for."""

    def __missing__(self, word: str) -> int:
        import xxhash

        got = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return got


def word_hashes(words: list[str], cache: WordHashes) -> np.ndarray:
    if len(cache) > 1_000_000:
        cache.clear()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingle_hashes(h: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hash of every run of ``k`` words (all of them if there are fewer)."""
    if len(h) == 0:
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    x = np.full(n, k, np.uint64)
    for j in range(k):
        x = (x ^ (x >> np.uint64(29))) * _ODD[0] + h[j:j + n] * _ODD[1 + j % 4]
    x = (x ^ (x >> np.uint64(32))) * _ODD[4]
    return x ^ (x >> np.uint64(31))


def simhash(shingles: np.ndarray) -> int:
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(shingles), bitorder="little").view("<u8")[0])


def window_simhashes(bit_sums: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the windows of ``n`` shingles at ``starts``; ``bit_sums``
    are running sums of the shingles' bits with a leading zero row."""
    c = bit_sums[starts + n] - bit_sums[starts]
    return np.packbits(2 * c > n, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: list[tuple], b: Counter, n: int) -> float:
    """Weighted similarity of shingles ``a`` and counted shingles ``b`` (``n`` in all)."""
    both = sum(min(c, b[s]) for s, c in Counter(a).items())
    return both / (len(a) + n - both)


def word_shingles(words: list[str], k: int = SHINGLE) -> list[tuple]:
    k = min(k, len(words))
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)] if words else []


class ItemIndex:
    """Index of one block of items, by their length in words."""

    def __init__(self, items: list[tuple], shingle: int = SHINGLE, sim: float = SIMILARITY, radius: int = RADIUS):
        self.shingle, self.sim, self.radius = shingle, sim, radius
        self.need = 2 * sim / (1 + sim)
        cache = WordHashes()
        self.by_length: dict[int, dict] = {}
        self.bitmaps: dict[int, np.ndarray] = {}
        near = radius // 8
        flips = [sum(1 << j for j in c) for r in range(near + 1) for c in combinations(range(8), r)]
        for item, text in items:
            words = words_of(text or "")
            if not words:
                continue
            h = shingle_hashes(word_hashes(words, cache), shingle)
            k = min(shingle, len(words))
            bits = self.bitmaps.setdefault(k, np.zeros(1 << (_BITMAP - 6), np.int64))
            pos = (h & np.uint64((1 << _BITMAP) - 1)).astype(np.int64)
            np.bitwise_or.at(bits, pos >> 6, np.int64(1) << (pos & 63))
            own = self.by_length.setdefault(len(words), {"ids": [], "fps": [], "shingles": [], "blocks": [[0] * 256 for _ in range(8)], "n": len(h), "k": k})
            at, fp = len(own["ids"]), simhash(h)
            own["ids"].append(item)
            own["fps"].append(fp)
            own["shingles"].append(Counter(word_shingles(words, shingle)))
            for b in range(8):
                part = (fp >> (8 * b)) & 255
                for f in flips:
                    own["blocks"][b][part ^ f] |= 1 << at  # the items of a block value, as bits
        # items of one shingle length by rising length: what a window needs rises too
        self.lengths: dict[int, list[tuple[int, dict]]] = {}
        for length in sorted(self.by_length):
            own = self.by_length[length]
            self.lengths.setdefault(own["k"], []).append((length, own))

    def matches(self, text: str, cache: WordHashes) -> list[tuple]:
        """``(item, first word, words, similarity)`` of every window that matches."""
        words = words_of(text)
        if not words:
            return []
        hashes = word_hashes(words, cache)
        out: list[tuple] = []
        for k, lengths in self.lengths.items():
            if k <= len(words):
                s = shingle_hashes(hashes, k)
                hit = bitmap_hits(self.bitmaps[k], s, _BITMAP)
                total = int(hit.sum())
                if total:
                    out += self._of_lengths(lengths, words, s, np.concatenate(([0], np.cumsum(hit))), total)
        return out

    def _of_lengths(self, lengths: list[tuple[int, dict]], words: list[str], s: np.ndarray, hits: np.ndarray, total: int) -> list[tuple]:
        """Matches of items whose shingles are as long as those hashed in ``s``;
        ``hits`` are running sums of the shingles that occur in some item."""
        out: list[tuple] = []
        for length, own in lengths:
            n = own["n"]
            short = length > len(words)
            size = min(n, len(s))  # shingles of a window
            least = ceil(self.need * (size + n) / 2 - 1e-9)
            if total < least or size < max(1, self.sim * n - 1e-9):
                break  # so it is for every longer item
            if short:
                mine = word_shingles(words, self.shingle)
                for item, theirs in zip(own["ids"], own["shingles"]):
                    got = similarity(mine, theirs, n)
                    if got >= self.sim:
                        out.append((item, 0, len(words), got))
                continue
            starts = np.flatnonzero(hits[n:] - hits[:-n] >= least)
            if len(starts) == 0:
                continue
            fps = self._fingerprints(s, starts, n)
            b0, b1, b2, b3, b4, b5, b6, b7 = own["blocks"]
            for start, fp in zip(starts.tolist(), fps.tolist()):
                found = (b0[fp & 255] | b1[fp >> 8 & 255] | b2[fp >> 16 & 255] | b3[fp >> 24 & 255]
                         | b4[fp >> 32 & 255] | b5[fp >> 40 & 255] | b6[fp >> 48 & 255] | b7[fp >> 56])
                near = [at for at in _bits(found) if (own["fps"][at] ^ fp).bit_count() <= self.radius]
                if near:
                    mine = word_shingles(words[start:start + length], self.shingle)
                    for at in near:
                        got = similarity(mine, own["shingles"][at], n)
                        if got >= self.sim:
                            out.append((own["ids"][at], start, length, got))
        return out

    @staticmethod
    def _fingerprints(s: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the windows at ``starts``; running sums of bits are
        kept only over the stretches that hold windows."""
        fps = np.empty(len(starts), np.uint64)
        group = np.flatnonzero(np.concatenate(([True], np.diff(starts) > n)))
        for a, z in zip(group, np.append(group[1:], len(starts))):
            while a < z:
                part = starts[a:min(z, a + 8192)]
                lo, hi = part[0], part[-1] + n
                bits = np.unpackbits(s[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                sums = np.zeros((len(bits) + 1, 64), np.int32)
                np.cumsum(bits, axis=0, out=sums[1:])
                fps[a:a + len(part)] = window_simhashes(sums, part - lo, n)
                a += len(part)
        return fps


def _bits(mask: int) -> list[int]:
    """Numbers of the bits set."""
    out = []
    while mask:
        low = mask & -mask
        out.append(low.bit_length() - 1)
        mask ^= low
    return out


def best_per_item(found: list[tuple]) -> list[tuple]:
    """The most similar window of each item (the first of equals), and how many matched."""
    best: dict = {}
    for item, start, length, sim in found:
        old = best.get(item)
        if old is None:
            best[item] = [item, start, length, sim, 1]
        else:
            old[4] += 1
            if (sim, -start) > (old[3], -old[1]):
                old[1:4] = start, length, sim
    return [tuple(v) for v in best.values()]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> Iterator[list[tuple]]:
    """The items in blocks that are small enough to send to every task."""
    slim = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    block, size = [], 0
    for r in slim.orderBy("i", "t").toLocalIterator():
        # rows of one id stay together: the best window of an item is one row
        if (size >= block_bytes or len(block) >= block_items) and r.i != block[-1][0]:
            yield block
            block, size = [], 0
        block.append((r.i, r.t))
        size += len(r.t)
    if block:
        yield block


def with_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 out_col: str = "matches", shingle: int = SHINGLE, sim: float = SIMILARITY, radius: int = RADIUS,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``out_col``: an array of (item, first_word, n_words,
    similarity, windows), one entry per item found, empty if clean."""
    kind = items.schema[item_id].dataType
    entry = StructType([StructField("item", kind), StructField("first_word", IntegerType()), StructField("n_words", IntegerType()),
                        StructField("similarity", DoubleType()), StructField("windows", IntegerType())])
    docs = docs.drop(out_col)
    cols = docs.columns
    schema = StructType([StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(cols)] + [StructField(f"c{len(cols)}", ArrayType(entry))])
    out, first = docs, True
    for block in item_blocks(items, item_id, item_text, block_bytes):
        last = out.columns[-1] if not first else None
        sent = out.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)],
                          (F.array().cast(ArrayType(entry)) if first else F.col(f"`{last}`")).alias(f"c{len(cols)}"))

        def run(batches: Iterator[pa.RecordBatch], block=block, at=cols.index(text_col)) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(block, shingle, sim, radius)
            cache = worker_cache("decontaminate_words").setdefault("hashes", WordHashes())
            for b in batches:
                got = []
                for t, old in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                    new = best_per_item(index.matches(t, cache)) if t else []
                    got.append(old + [dict(zip(("item", "first_word", "n_words", "similarity", "windows"), m)) for m in new])
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, b.schema.field(b.num_columns - 1).type)], names=b.schema.names)

        out, first = sent.mapInArrow(run, schema).toDF(*cols, out_col), False
    return out.withColumn(out_col, F.array().cast(ArrayType(entry))) if first else out


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``(doc_id, item_id, first_word, n_words, similarity, windows)``: a row
    for every document and item that match."""
    got = with_matches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), items, **settings)
    return got.select("doc_id", F.explode("matches").alias("m")).select("doc_id", F.col("m.item").alias("item_id"), "m.first_word", "m.n_words", "m.similarity", "m.windows")


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    cols = docs.columns
    return with_matches(docs, items, text_col, out_col="__matches", **settings).where(F.size("__matches") == 0).select(*[F.col(f"`{c}`") for c in cols])


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, first_word, n_words, similarity, windows."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
