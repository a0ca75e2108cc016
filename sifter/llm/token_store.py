"""Token-id output in ORC.

Whole texts are encoded with the tokenizers library, the end id is appended,
and the documents are written in ascending id order as ORC: one
``array<int>`` of ids per row (ORC's integer run-length encoding), a row index
every ``ROW_INDEX_STRIDE`` rows and Bloom filters on the document id, so that a
look-up by id skips files, stripes and row groups by metadata alone, and a scan
reads stripes in parallel.

Order without a global sort in one task: the rows are range-partitioned on the
id (Spark samples ids only), sorted inside each partition and written as one or
more files; ``part`` and the id give the global order. The start of a document
is the sum over the parts before it (one row per part) plus a running sum in
its part.

Words never share a token across ASCII blanks in this tokenizer (blanks are
dropped before the merges), so the distinct words of a chunk of texts are looked
up in a worker-wide, bounded cache and only unseen ones go through
``encode_batch_fast``. ``word_safe`` checks that property of the tokenizer file; a
file without it is encoded text by text. Words of letters, perhaps with marks
behind them, share the ids of their letters in lower case and of their marks,
where ``letters_apart`` finds that the tokenizer parts them so.

Defined results: null text counts as empty (the end id only); null ids come
first; rows that repeat an id are ordered by the hash of their text; an empty
table gives an empty folder that still has the schema. Columns other than id
and text are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.llm._common import read_table, text_chunks, worker_cache
from sifter.session import ensure_checkpoint_dir, materialise

END_ID = 1
ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20
#: Words a worker keeps; two generations of this size at most are held.
CACHE_WORDS = 500_000
#: A control character that is a pre-token of its own when set between blanks.
_MARK = "\x01"
#: Text that is cut into words at once, in bytes.
CHUNK_BYTES = 8 << 20
#: Letters (a character class) that normalizing leaves as they are but for their
#: case: Latin ones but those whose lower case is several characters, Cyrillic.
LETTERS = "".join(f"\\x{{{a:X}}}-\\x{{{z:X}}}" for a, z in (
    (0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x131, 0x137), (0x139, 0x148), (0x14A, 0x17E), (0x400, 0x45F)))
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MARK_CLASS = "!-/:-@\\[-`{-~"


def word_safe(path: str) -> bool:
    """True if the tokenizer treats blank-separated words independently: its
    normalizers work character by character or on runs of blanks, its pattern
    never matches a blank and drops it, and no added token holds a blank."""
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    norm, pre = t.get("normalizer") or {}, t.get("pre_tokenizer") or {}
    norms = norm.get("normalizers", [norm] if norm else [])
    pres = pre.get("pretokenizers", [pre] if pre else [])
    ok_norm = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " " for n in norms)
    ok_pre = bool(pres) and pres[0]["type"] == "Split" and pres[0]["behavior"] == "Removed" and pres[0]["invert"] and all(
        p["type"] == "ByteLevel" and not p["add_prefix_space"] for p in pres[1:])
    plain = all(not set(a["content"]) & set(" \t\n\x0b\x0c\r") and not (a["lstrip"] or a["rstrip"] or a["single_word"]) for a in t["added_tokens"])
    return ok_norm and ok_pre and plain


def letters_apart(path: str) -> bool:
    """True if a word of ``LETTERS`` and marks behind them is one pre-token of
    letters and one of marks, if the letters may be lower-cased first, and if
    the model ends every pre-token with a suffix of its own: then the letters go
    through the model alone, and its ids show where each word ends."""
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    model, pre = t["model"], t["pre_tokenizer"]["pretokenizers"]
    lower = any(n["type"] == "Lowercase" for n in (t.get("normalizer") or {}).get("normalizers", []))
    pattern = pre[0]["pattern"].get("Regex", "").split("|")
    apart = pattern[-3:] == ["[\\p{L}]+", "[\\p{N}]", "[^\\s\\p{L}\\p{N}]+"] and all(re.fullmatch("'[a-z]+", x) for x in pattern[:-3])
    added = all(re.fullmatch(r"<\|\w+\|>", a["content"]) for a in t["added_tokens"])
    whole = model["type"] == "BPE" and bool(model.get("end_of_word_suffix")) and not model.get("dropout")
    return lower and apart and added and whole and [p["type"] for p in pre[1:]] == ["ByteLevel"]


class WordEncoder:
    """Encodes texts to little-endian 32-bit ids with a word cache.

    A chunk of texts is cut into words, and these are numbered, by Arrow; only
    distinct words are looked up, only those not met before are encoded."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.by_word = word_safe(path)
        self.limit = cache_words
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        mark = self.tok.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.letters = None
        if self.by_word and letters_apart(path):  # the same model, without the steps that leave such letters as they are
            self.letters = Tokenizer(self.tok.model)
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            suffix, vocab = self.tok.model.end_of_word_suffix, self.tok.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for w, i in vocab.items() if w.endswith(suffix)]] = True

    def _plain(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of unseen words: many words per call, parted by a mark no word holds."""
        if self.mark is None:
            return self._plain(words)
        out: list[bytes] = []
        groups = [words[i:i + 200] for i in range(0, len(words), 200)]
        for group, e in zip(groups, self.tok.encode_batch_fast([f" {_MARK} ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(group) - 1:  # a word holds the mark, or its id came from a word
                out += self._plain(group)
                continue
            raw = ids.tobytes()
            at = 0
            for c in (cut * 4).tolist():
                out.append(raw[at:c])
                at = c + 4
            out.append(raw[at:])
        return out

    def _learn_letters(self, words: list[str]) -> list[bytes]:
        """Ids of unseen words of lower-case ``LETTERS``, one pre-token each."""
        out: list[bytes] = []
        groups = [words[i:i + 200] for i in range(0, len(words), 200)]
        for group, e in zip(groups, self.letters.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(group):  # a word whose last symbol the model does not have
                out += self._plain(group)
                continue
            raw, at = ids.tobytes(), 0
            for z in (ends * 4).tolist():
                out.append(raw[at:z])
                at = z
        return out

    def _ids(self, words: pa.Array, learn) -> pa.Array:
        """Ids of distinct words, from the cache or by ``learn``."""
        names, now, old = words.to_numpy(zero_copy_only=False).tolist(), self.now, self.old
        got = list(map(now.get, names))
        lack = [i for i, x in enumerate(got) if x is None]
        if old:
            for i in lack:
                got[i] = old.get(names[i])
            now.update((names[i], got[i]) for i in lack if got[i] is not None)
            lack = [i for i in lack if got[i] is None]
        if lack:
            fresh = [names[i] for i in lack]
            for i, w, x in zip(lack, fresh, learn(fresh)):
                got[i] = now[w] = x
        return pa.array(got, pa.large_binary())

    def _lettered(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words of ``LETTERS`` and marks behind them."""
        stem = pc.ascii_rtrim(words, _MARKS)
        marked = pc.less(pc.binary_length(stem), pc.binary_length(words))
        stem = pc.utf8_lower(stem).dictionary_encode()
        ids = self._ids(stem.dictionary, self._learn_letters).take(stem.indices)
        tail = pc.replace_substring_regex(words.filter(marked), f"^[{LETTERS}]+", "").dictionary_encode()
        at = np.full(len(words), len(tail.dictionary))
        at[marked.to_numpy(zero_copy_only=False)] = tail.indices.to_numpy()
        tails = pa.concat_arrays([self._ids(tail.dictionary, self._learn), pa.array([b""], pa.large_binary())])
        return pc.binary_join_element_wise(ids, tails.take(pa.array(at)), pa.scalar(b"", pa.large_binary()))

    def _chunk(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            raw = [x + end for x in self._plain([t or "" for t in texts.to_pylist()])]
            return np.frombuffer(b"".join(raw), "<i4"), np.array([len(x) // 4 for x in raw], np.int64)
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()
        if self.letters is None:
            ids = self._ids(words, self._learn)
        else:
            simple = pc.match_substring_regex(words, f"^[{LETTERS}]+[{_MARK_CLASS}]*$")
            ids = pa.concat_arrays([self._lettered(words.filter(simple)), self._ids(words.filter(pc.invert(simple)), self._learn)])
            flag = simple.to_numpy(zero_copy_only=False)
            place = np.empty(len(words), np.int64)
            place[flag] = np.arange(flag.sum())
            place[~flag] = np.arange(flag.sum(), len(words))
            at = place[at]
        if len(self.now) > self.limit:
            self.old, self.now = self.now, {}
        ids = pa.concat_arrays([ids, pa.array([end], pa.large_binary())])
        offsets -= offsets[0]
        got = ids.take(pa.array(np.insert(at, offsets[1:], len(ids) - 1)))
        bounds = np.frombuffer(got.buffers()[1], np.int64)[offsets + np.arange(len(offsets))] // 4
        flat = np.frombuffer(got.buffers()[2], "<i4") if bounds[-1] else np.zeros(0, "<i4")
        return flat[:bounds[-1]], np.diff(bounds)

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(first, ids, lengths)`` of runs of whole texts, ``end`` behind each text's ids."""
        for first, rows in text_chunks(texts, CHUNK_BYTES):
            yield first, *self._chunk(texts.slice(first, rows), end)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for _, ids, lengths in self.encode_array(pa.array(texts, pa.large_string())):
            raw, ends = ids.tobytes(), np.cumsum(lengths) * 4
            out += [raw[z - 4 * n:z] for n, z in zip(lengths.tolist(), ends.tolist())]
        return out


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for ``path`` (made once per worker)."""
    home = worker_cache("word_encoder")
    if path not in home:
        home[path] = WordEncoder(path)
    return home[path]


def encode_ids(rows: DataFrame, path: str, text_at: int, end_id: int = END_ID):
    """Map function for batches whose column ``text_at`` is the text; that
    column is replaced by the list of ids, others pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for i, flat, lengths in enc.encode_array(b.column(text_at), end):
                part = b.slice(i, len(lengths))
                offsets = np.concatenate(([0], np.cumsum(lengths)))
                cols = list(part.columns)
                cols[text_at] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    return run


def write_token_store(docs: DataFrame, out_dir: str, vocab: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID, partitions: int | None = None) -> None:
    """Write ``docs`` as a token store under ``out_dir`` (overwritten).

    Columns: ``doc_id``, ``part`` (range partition, ascending with the id),
    ``th`` (hash of the text, orders repeated ids), ``ids``."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("ids"))
    dealt = (slim.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "th")
             .withColumn("part", F.spark_partition_id())
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "th")
             .select("doc_id", "th", "part", "ids"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    coded = dealt.mapInArrow(encode_ids(dealt, vocab, 3, end_id), f"doc_id {kind}, th bigint, part int, ids array<int>")
    (coded.write.mode("overwrite").option("compression", "zstd")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(ROW_INDEX_STRIDE)).option("orc.stripe.size", str(STRIPE_BYTES))
     .orc(out_dir))


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def lookup(spark: SparkSession, path: str, ids: list) -> DataFrame:
    """Rows of the documents named: the id filter is pushed down to file
    statistics, row indexes and Bloom filters."""
    return read_token_store(spark, path).where(F.col("doc_id").isin(ids))


def token_index(store: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per row of a store."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            off = ids.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8))
            crc = np.array([zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(off[:-1].tolist(), off[1:].tolist())], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.diff(off)), pa.array(crc)],
                                             names=["doc_id", "th", "part", "n_tokens", "ids_crc32"])

    kind = store.schema["doc_id"].dataType.simpleString()
    rows = materialise(store.select("doc_id", "th", "part", "ids").mapInArrow(
        run, f"doc_id {kind}, th bigint, part int, n_tokens bigint, ids_crc32 bigint"), "token-index")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    before = totals.select(F.col("part").alias("part_"), (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    run_sum = F.sum("n_tokens").over(Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "th")
                                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("run", run_sum).join(F.broadcast(before), F.col("part") == F.col("part_"))
            .select("doc_id", (F.col("before") + F.col("run") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32"))


def op3_token_store(spark: SparkSession, sf_dir: str, out_dir: str | None = None) -> DataFrame:
    """Contract: doc_id, start, n_tokens, ids_crc32, read back from the files."""
    import uuid

    import public_tokenizers

    out = out_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/sifter-tokens/{uuid.uuid4().hex}"
    write_token_store(read_table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"))
    return token_index(read_token_store(spark, out))
