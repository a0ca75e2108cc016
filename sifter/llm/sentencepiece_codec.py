"""SentencePiece encoding and decoding on the tokenizers library.

The ``.model`` protobuf is parsed here (pieces, scores, types, normaliser and
trainer fields), and an equal ``Tokenizer`` is rebuilt: the normaliser's
character map, extra-blank and dummy-prefix rules, the metaspace marker, byte
fallback, and the model itself. A unigram model takes the scores as they are; a
BPE model (the given vocabulary is one) takes them as merge ranks.

If no piece holds the marker after another character, no merge crosses from a
word into the next blank: ``blanks + word`` units are then encoded on their own,
each once per worker (bounded cache), in multithreaded ``encode_batch`` calls.
Parity: each new unit is also encoded by the sentencepiece library; a
difference, if any, is corrected to its result and counted (``mismatches``).
Models outside this form are encoded text by text, with the same comparison.

Decoding is the tokenizers decoder chain (marker to blank, byte fallback, fuse,
strip the dummy prefix) in multithreaded ``decode_batch`` calls.

Defined results: null text counts as empty and gives no ids; empty tables give
no rows; repeated rows are encoded alike; extra columns pass through unless
they have the names of the outputs, which are replaced. The marker character in
a text decodes as a blank, as in the sentencepiece library.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from sifter.llm._common import read_table, worker_cache

MARK = "▁"
CACHE_UNITS = 200_000
# fixed values of the model format
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(field number, value)`` of one protobuf message."""
    i, n = 0, len(buf)

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            b = buf[i]
            i += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while i < n:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, buf[i:i + size]
            i += size


def parse_model(path: str) -> dict:
    """Pieces ``(text, score, type)`` and the normaliser and trainer fields."""
    with open(path, "rb") as f:
        raw = f.read()
    pieces, trainer, norm = [], {}, {}
    for number, value in _fields(raw):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for k, v in _fields(value):
                if k == 1:
                    text = v.decode()
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            pieces.append((text, score, kind))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            norm = dict(_fields(value))
    return {"pieces": pieces, "model_type": trainer.get(3, UNIGRAM), "byte_fallback": bool(trainer.get(35, 0)),
            "charsmap": norm.get(2, b""), "dummy_prefix": bool(norm.get(3, 1)), "squeeze": bool(norm.get(4, 1)),
            "escape": bool(norm.get(5, 1))}


def build_tokenizer(spec: dict, dummy_prefix: bool | None = None):
    """The tokenizers ``Tokenizer`` for a parsed model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    prefix = spec["dummy_prefix"] if dummy_prefix is None else dummy_prefix
    pieces = spec["pieces"]
    vocab = {p: i for i, (p, _, _) in enumerate(pieces)}
    unk = next((i for i, (_, _, k) in enumerate(pieces) if k == UNKNOWN), 0)
    if spec["model_type"] == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in pieces], unk_id=unk, byte_fallback=spec["byte_fallback"])
    elif spec["model_type"] == BPE:
        usable = {p: (-s, i) for i, (p, s, k) in enumerate(pieces) if k in (NORMAL, USER_DEFINED)}
        merges = []
        for p, rank in usable.items():
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if a in usable and b in usable:
                    merges.append((rank, usable[a], usable[b], a, b))
        merges.sort()
        model = models.BPE(vocab, [(a, b) for _, _, _, a, b in merges], unk_token=pieces[unk][0], fuse_unk=True,
                           byte_fallback=spec["byte_fallback"])
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    tok = Tokenizer(model)
    steps = []
    if spec["charsmap"]:
        steps.append(normalizers.Precompiled(spec["charsmap"]))
    if spec["squeeze"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix:
        steps.append(normalizers.Prepend(MARK))
    if spec["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tok.normalizer = normalizers.Sequence(steps)
    chain = [decoders.Replace(MARK, " ")] + ([decoders.ByteFallback()] if spec["byte_fallback"] else []) + [decoders.Fuse()]
    if spec["dummy_prefix"]:
        chain.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(chain)
    return tok


def splits_at_blanks(spec: dict) -> bool:
    """True if units of blanks and a word can be encoded one by one."""
    inner = re.compile(f"[^{MARK}]{MARK}")
    return (not spec["charsmap"] and not spec["squeeze"] and spec["escape"] and spec["dummy_prefix"]
            and not any(k == USER_DEFINED or inner.search(p) for p, _, k in spec["pieces"]))


class SentencePieceCodec:
    """Encoder and decoder for one model file."""

    _UNIT = re.compile(" *[^ ]+| +")

    def __init__(self, path: str, cache_units: int = CACHE_UNITS, threads: int | None = None, verify: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        if threads:
            os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        spec = parse_model(path)
        self.units = splits_at_blanks(spec)
        self.tok = build_tokenizer(spec)
        self.unit_tok = build_tokenizer(spec, dummy_prefix=False)
        self.ref = sentencepiece.SentencePieceProcessor(model_file=path) if verify else None
        self.lone = np.array(self.unit_tok.encode(" ", add_special_tokens=False).ids, "<u4").tobytes()
        self.begins = np.array([p.startswith(MARK) for p, _, _ in spec["pieces"]])
        self.limit = cache_units
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.mismatches = 0
        self.corrected: set[str] = set()

    def _checked(self, texts: list[str], encodings, units: list[str] | None = None) -> list[bytes]:
        out = [np.array(e.ids, "<u4").tobytes() for e in encodings]
        if self.ref is not None:
            for i, want in enumerate(self.ref.encode(texts, num_threads=1)):
                want = np.array(want, "<u4").tobytes()
                if want != out[i] and texts[i]:
                    self.mismatches += 1
                    self.corrected.add((units or texts)[i])
                    out[i] = want
        return out

    def _one_by_one(self, units: list[str]) -> list[bytes]:
        """Units start with the blank that stands for the marker: for the
        sentencepiece library that blank is its dummy prefix. A lone blank is
        the marker itself (the library gives an empty text no prefix)."""
        got = self._checked([u[1:] for u in units], self.unit_tok.encode_batch_fast(units, add_special_tokens=False), units)
        return [self.lone if u == " " else g for u, g in zip(units, got)]

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """Ids of unseen units. Units of one blank and a word are encoded many
        to a string and parted where a piece begins with the marker; a string
        on which the libraries differ or the parts don't fit goes unit by unit."""
        plain = [u for u in units if len(u) > 1 and u[1] != " "]
        other = [u for u in units if not (len(u) > 1 and u[1] != " ")]
        out: dict[str, bytes] = {}
        groups = [plain[i:i + 200] for i in range(0, len(plain), 200)]
        joined = ["".join(g) for g in groups]
        want = self.ref.encode([x[1:] for x in joined], num_threads=1) if self.ref is not None else [None] * len(groups)
        for group, e, w in zip(groups, self.unit_tok.encode_batch_fast(joined, add_special_tokens=False), want):
            ids = np.array(e.ids, "<u4")
            cut = np.flatnonzero(self.begins[ids])
            if len(cut) != len(group) or (w is not None and w != e.ids):
                other += group
                continue
            raw, at = ids.tobytes(), (np.append(cut, len(ids)) * 4).tolist()
            out.update((u, raw[a:z]) for u, a, z in zip(group, at, at[1:]))
        out.update(zip(other, self._one_by_one(other)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit id bytes per text."""
        return self.encode_counted(texts)[0]

    def encode_counted(self, texts: list[str]) -> tuple[list[bytes], list[int]]:
        """``encode``, and for each text the number of its units whose ids are
        those of the sentencepiece library, since the two libraries differ."""
        if not self.units:
            self.corrected.clear()
            out = self._checked(texts, self.tok.encode_batch_fast(texts, add_special_tokens=False))
            return out, [int(t in self.corrected) for t in texts]
        find = self._UNIT.findall
        split = [find(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        now, old = self.now, self.old
        fresh = []
        for u in set().union(*split) if split else ():
            if u not in now:
                got = old.get(u)
                if got is None:
                    fresh.append(u)
                else:
                    now[u] = got
        if fresh:
            # a unit without a leading blank cannot occur: every text starts with one and units end before blanks
            now.update(self._learn(fresh))
        look = now.__getitem__
        out = [b"".join(map(look, us)) for us in split]
        bad = self.corrected
        counts = [sum(u in bad for u in us) for us in split] if bad else [0] * len(texts)
        if len(now) > self.limit:
            self.old, self.now = now, {}
            self.corrected = {u for u in bad if u in now}
        return out, counts

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=False)


def codec(path: str) -> SentencePieceCodec:
    home = worker_cache("sentencepiece")
    if path not in home:
        home[path] = SentencePieceCodec(path)
    return home[path]


def _appended(docs: DataFrame, fields: list[StructField], sent_col: str, run) -> DataFrame:
    """``docs`` plus output columns computed by ``run`` from ``sent_col``, which
    travels as the last column; columns of the outputs' names are replaced."""
    docs_out = docs.drop(*[f.name for f in fields])
    cols = docs_out.columns
    sent = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], F.col(f"`{sent_col}`").alias(f"c{len(cols)}"))
    schema = StructType([StructField(f"c{i}", docs_out.schema[c].dataType) for i, c in enumerate(cols)]
                        + [StructField(f"c{len(cols) + i}", f.dataType) for i, f in enumerate(fields)])
    return sent.mapInArrow(run, schema).toDF(*cols, *[f.name for f in fields])


def encode(docs: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of the whole text appended as ``array<int>``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                raw = c.encode([t or "" for t in part.column(part.num_columns - 1).to_pylist()])
                offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in raw])))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=[f"c{k}" for k in range(part.num_columns)])

    return _appended(docs, [StructField(out_col, ArrayType(IntegerType()))], text_col, run)


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids stand for appended (null ids: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                texts = c.decode([x or [] for x in part.column(part.num_columns - 1).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[f"c{k}" for k in range(part.num_columns)])

    return _appended(docs, [StructField(out_col, StringType())], ids_col, run)


def round_trip(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian 32-bit integers), ``round_trip`` (decoding the ids gives
    the text back, blanks for marker characters) and ``n_corrected`` (units on
    which the libraries differ, with the sentencepiece library's ids): encode and decode in one
    pass over the rows, so neither ids nor texts travel twice."""
    fields = [StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()),
              StructField("ids_crc32", LongType()), StructField("round_trip", BooleanType()), StructField("n_corrected", LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                raw, corrected = c.encode_counted(texts)
                flat = np.frombuffer(b"".join(raw), "<i4")
                offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in raw])))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                back = c.decode([np.frombuffer(x, "<u4").tolist() for x in raw])
                same = [x == t.replace(MARK, " ") for x, t in zip(back, texts)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], ids, pa.array(np.diff(offsets), pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(same),
                     pa.array(corrected, pa.int64())], names=[f"c{k}" for k in range(part.num_columns + 4)])

    return _appended(docs, fields, text_col, run)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, ids, n_tokens, ids_crc32, round_trip, n_corrected."""
    return round_trip(read_table(spark, sf_dir, "documents").select("doc_id", "text"), model_path()).drop("text")
