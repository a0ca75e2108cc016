"""Token counts of every prefix of a text, by dynamic programming.

A byte-pair encoding has one property that makes prefixes cheap: a row of tokens
is the encoding of its bytes exactly if every pair of neighbours is (no merge
runs over the place where the two meet before both are made). So the last token
of the encoding of a prefix is the one token that ends there and may stand
behind the last token of the prefix before it, and

    count(prefix) = count(prefix without its last token) + 1

One left-to-right pass over a word gives the exact count of *every* prefix of
it; nothing is encoded twice. ``PrefixTable`` does that for a merges file of the
tokenizers library with the usual byte-level word pattern.

Words are cut so that what stands behind a unit never changes the counts inside
it: a unit is a run of white space with the word, number, symbol run or
contraction behind it. Its counts are those of its prefixes as texts of their
own: a run of blanks at the end of a prefix is one word there, while before
another word its last blank belongs to that word; ``'re`` cut to ``'r`` is two
words. A special string of the vocabulary is one token, and its proper prefixes
are ordinary text. The counts of a document are then running sums of the
differences stored per unit, so a document costs one dictionary look-up a unit.

``prefix_counts`` adds the column ``prefix_tokens array<int>`` (entry i: tokens of
the first i characters, entry 0 is 0, the last is the whole text). Counts of
prefixes do not always rise, so the budget functions ask for the *longest*
prefix within a budget. They are Spark expressions over the stored column:
no text is encoded again.

Defined results: null text counts as empty (``prefix_tokens`` [0]); very long
texts and words cost time in proportion to their length and are never cut;
repeated rows and null ids stay as they are; an empty table gives an empty one;
further columns pass, and an existing ``prefix_tokens`` column is replaced.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.llm._common import read_table, worker_cache

LIMIT = 512
#: Units whose counts a worker keeps; two generations of this size at most.
CACHE_UNITS = 300_000
#: Characters of the texts whose units are counted together (a longer text is a
#: slice of its own).
SLICE_CHARS = 4_000_000
#: Longer units are counted each time.
CACHE_CHARS = 64
#: Neighbour pairs whose answer a worker keeps.
CACHE_PAIRS = 1_000_000
#: The word pattern this module knows, as the library's byte-level step has it.
_CONTRACTIONS = "s|t|re|ve|m|ll|d"
_UNITS = rf"(?:\s*[^\S ])?'(?:{_CONTRACTIONS})|\s*(?:\p{{L}}+|\p{{N}}+|[^\s\p{{L}}\p{{N}}]+)|\s+"
#: Below this code point the regex module and the library agree on letters,
#: numbers and white space; above it every character is asked for once.
_AGREED = 0x500


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class _Pairs(dict):
    """May token ``b`` stand behind token ``a``? Answers by ``a << 20 | b``."""

    def __init__(self, ask):
        super().__init__()
        self.ask = ask

    def __missing__(self, key: int) -> bool:
        if len(self) >= CACHE_PAIRS:
            self.clear()
        got = self[key] = self.ask(key >> 20, key & 0xFFFFF)
        return got


class _Units(dict):
    """Differences of prefix counts by unit, two generations."""

    def __init__(self, steps, limit: int):
        super().__init__()
        self.steps, self.limit, self.old = steps, limit, {}

    def __missing__(self, unit: str) -> bytes:
        got = self.old.get(unit)
        if got is None:
            got = self.steps(unit)
        if len(unit) <= CACHE_CHARS:
            self[unit] = got
        return got

    def learn(self, units: set[str]) -> None:
        """Count the unseen of ``units`` in order, so that each shares the
        prefixes of the one before; afterwards the old generation may go."""
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        for unit in sorted(units.difference(self)):
            self[unit]


class PrefixTable:
    """Counts of every prefix under one tokenizer file."""

    def __init__(self, path: str, cache_units: int = CACHE_UNITS):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._check(spec)
        self.specials = sorted((a["content"] for a in spec["added_tokens"]), key=lambda s: (-len(s), s))
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.split = regex.compile(_UNITS).findall
        self.spans = regex.compile(_UNITS).finditer
        self.space = regex.compile(r"\s*").match
        self.beyond = regex.compile(f"[^\\x00-{chr(_AGREED - 1)}]")
        self.words = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.own_words = regex.compile(rf"'(?:{_CONTRACTIONS})| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+").finditer
        self.stand_in: dict[str, str] = {}
        self._load_merges(spec["model"]["merges"])
        self.pairs = _Pairs(self.may_follow)
        self.word, self.last, self.count = b"", [-1], [0]
        self.units = _Units(self.unit_steps, cache_units)

    @staticmethod
    def _check(spec: dict) -> None:
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout")
                 and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
                 and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in spec["added_tokens"]))
        if not plain:
            raise ValueError("prefix counts need a plain byte-level BPE file")

    # -- the vocabulary ---------------------------------------------------

    def _load_merges(self, merges: list) -> None:
        symbol = byte_symbols()
        number = {bytes([b]): b for b in range(256)}
        self.rank: dict[tuple[int, int], int] = {}
        self.made = [-1] * 256  # rank of the merge that makes a token
        self.left, self.right = [0] * 256, [0] * 256
        raw = {c: bytes([b]) for c, b in symbol.items()}

        def to_bytes(s: str) -> bytes:
            return b"".join(raw[c] for c in s)

        for k, m in enumerate(merges):
            a, b = map(to_bytes, m.split(" ") if isinstance(m, str) else m)
            if a + b not in number:
                number[a + b] = len(self.made)
                self.made.append(k)
                self.left.append(number[a])
                self.right.append(number[b])
            self.rank.setdefault((number[a], number[b]), k)
        usable = [True] * 256
        for t in range(256, len(self.made)):
            a, b = self.left[t], self.right[t]
            usable.append(usable[a] and usable[b] and self._apart(a, b, self.made[t]))
        self.trie: dict = {}  # tokens from their last byte to their first
        for w, t in number.items():
            if usable[t]:
                node = self.trie
                for byte in reversed(w):
                    node = node.setdefault(byte, {})
                node[-1] = t

    def _apart(self, a: int, b: int, limit: float) -> bool:
        """No merge over the border of ``a b`` runs before rank ``limit``.

        The tokens' own merges are taken back, the later one first; after each
        the two tokens that now touch must not have merged any earlier. Of two
        merges of one rank the left one runs first."""
        while True:
            r = self.rank.get((a, b))
            if r is not None and r < limit:
                return False
            ra, rb = self.made[a], self.made[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, self.right[a]
            else:
                limit, b = rb + 1, self.left[b]

    def may_follow(self, a: int, b: int) -> bool:
        return self._apart(a, b, float("inf"))

    # -- one word ---------------------------------------------------------

    def word_counts(self, word: bytes) -> list[int]:
        """Tokens of ``word[:i]`` for every i.

        The entries of the prefix shared with the word before are kept, so
        words that come in order cost their new prefixes only."""
        last, count, pairs, trie = self.last, self.count, self.pairs, self.trie
        k = 0
        for x, y in zip(self.word, word):
            if x != y:
                break
            k += 1
        del last[k + 1:], count[k + 1:]
        for i in range(k, len(word)):
            node, j = trie, i
            while True:
                node = node[word[j]]
                t = node.get(-1)
                if t is not None and (j == 0 or pairs[last[j] << 20 | t]):
                    break
                j -= 1
            last.append(t)
            count.append(count[j] + 1)
        self.word = word
        return count

    def char_counts(self, word: str) -> list[int]:
        raw = word.encode()
        count = self.word_counts(raw)
        if len(raw) == len(word):
            return count.copy()
        return [count[i] for i in range(len(raw)) if raw[i] & 0xC0 != 0x80] + [count[-1]]

    # -- one unit ---------------------------------------------------------

    def unit_counts(self, unit: str) -> list[int]:
        """Tokens of ``unit[:k]``, each prefix a text of its own, k from 0."""
        m = self.space(unit).end()
        if m < len(unit) and (m == 0 and unit[0] != "'" or m == 1 and unit[0] == " "):
            return self.char_counts(unit)  # one word
        return self._spaced(unit[:m], unit[m:])

    def _spaced(self, space: str, body: str) -> list[int]:
        m = len(space)
        runs = self.char_counts(space) if m else [0]
        if not body:
            return runs
        if m and space[-1] == " ":
            return runs + [runs[m - 1] + c for c in self.char_counts(" " + body)[2:]]
        before = 0 if not m else runs[1] if m == 1 else runs[m - 1] + self.char_counts(space[-1])[-1]
        counts = self.char_counts(body)
        if body[0] == "'" and len(body) > 2 and body[1].isalpha():  # 're, 've, 'll: the shorter prefix is two words
            counts[2] = counts[1] + self.char_counts(body[1])[-1]
        return runs + [before + c for c in counts[1:]]

    def unit_steps(self, unit: str) -> bytes:
        c = self.unit_counts(unit)
        return array("h", map(sub, c[1:], c)).tobytes()

    # -- texts ------------------------------------------------------------

    def _class_of(self, c: str) -> str:
        """``c`` itself where both pattern engines agree, else a character of
        the class that the library gives it."""
        probe = f"a{c}1{c}{c}!"
        want = [s for _, s in self.words(probe)]
        for stand in (c, "x", "7", "!", "\n"):
            text = f"a{stand}1{stand}{stand}!"
            if [m.span() for m in self.own_words(text)] == want:
                return stand
        raise ValueError(f"no class for U+{ord(c):04X}")

    def _split(self, text: str) -> list[str]:
        far = self.beyond.search(text)
        if far is None:
            return self.split(text)
        stand_in = self.stand_in
        for c in set(text):
            if ord(c) >= _AGREED and c not in stand_in:
                stand_in[c] = self._class_of(c)
        odd = {ord(c): stand_in[c] for c in set(text) if ord(c) >= _AGREED and stand_in[c] != c}
        if not odd:
            return self.split(text)
        return [text[m.start():m.end()] for m in self.spans(text.translate(odd))]

    def _plain_steps(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, self._split(text)))

    def counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for i from 0 to the length of the text."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self._sum(self._plain_steps(text))
        out, base, at = [np.zeros(1, np.int32)], 0, 0
        for m in self.special_pattern.finditer(text):
            # up to the special string, and its proper prefixes as ordinary text
            part = self._sum(self._plain_steps(text[at:m.end() - 1])) + base
            base = int(part[m.start() - at]) + 1
            out += [part[1:], np.array([base], np.int32)]
            at = m.end()
        out.append(self._sum(self._plain_steps(text[at:]))[1:] + base)
        return np.concatenate(out)

    @staticmethod
    def _sum(steps: bytes) -> np.ndarray:
        out = np.zeros(len(steps) // 2 + 1, np.int32)
        np.cumsum(np.frombuffer(steps, np.int16), dtype=np.int32, out=out[1:])
        return out

    def counts_of(self, texts: list[str]) -> list[np.ndarray]:
        """``counts`` of many texts; their unseen units are counted in order."""
        special = self.special_pattern
        split = [None if special is not None and special.search(t) else self._split(t) for t in texts]
        self.units.learn(set().union(*(s for s in split if s is not None)))
        look = self.units.__getitem__
        return [self.counts(t) if s is None else self._sum(b"".join(map(look, s))) for t, s in zip(texts, split)]


def prefix_table(path: str) -> PrefixTable:
    """The worker's table for ``path`` (made once per worker)."""
    home = worker_cache("prefix_table")
    if path not in home:
        home[path] = PrefixTable(path)
    return home[path]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of slices of about ``SLICE_CHARS``."""
    sizes = pc.utf8_length(texts).to_pylist()
    first = chars = 0
    for i, n in enumerate(sizes):
        if chars and chars + n > SLICE_CHARS:
            yield first, i - first
            first, chars = i, 0
        chars += n
    if first < len(sizes):
        yield first, len(sizes) - first


def prefix_counts(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "prefix_tokens") -> DataFrame:
    """``docs`` plus ``out_col array<int>``: tokens of the first i characters.

    Narrow: one pass over the rows; memory is that of a slice of texts and the
    bounded caches."""
    kept = [c for c in docs.columns if c != out_col]
    at = len(kept)
    # by position: names may clash
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)],
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(path)
        for b in batches:
            for i, n in _slices(b.column(at)):
                part = b.slice(i, n)
                got = table.counts_of(part.column(at).to_pylist())
                offsets = np.concatenate(([0], np.cumsum([len(c) for c in got])))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(got)))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], lists], names=[*part.schema.names[:at], "t"])

    schema = T.StructType([*rows.schema.fields[:at], T.StructField("t", T.ArrayType(T.IntegerType()))])
    got = rows.mapInArrow(run, schema)
    return got.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col("t").alias(out_col))


def total_tokens(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.element_at(counts, -1).cast("bigint")


def tokens_of_prefix(counts: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters (of all, if the text has fewer)."""
    n = F.lit(chars) if isinstance(chars, int) else chars
    return F.get(counts, F.least(F.greatest(n, F.lit(0)), F.size(counts) - 1)).cast("bigint")


def longest_within(counts: Column, budget: int) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    return F.aggregate(F.transform(counts, lambda c, i: F.when(c <= budget, i).otherwise(F.lit(0))), F.lit(0), lambda a, b: F.greatest(a, b))


def truncate(text: Column, counts: Column, budget: int) -> Column:
    """The longest prefix of ``text`` that has at most ``budget`` tokens."""
    return F.substring(F.coalesce(text, F.lit("")), F.lit(1), longest_within(counts, budget))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: doc_id, n_bytes, n_tokens, over_limit; from the counts of all
    prefixes of every whole text."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    got = prefix_counts(docs.select("doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes")),
                        public_tokenizers.path("byte_bpe_50k.json"))
    n = total_tokens(F.col("prefix_tokens"))
    return got.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > LIMIT).alias("over_limit"))
