"""File sources: document and slide-deck folders, text lines, whole-file
passages and page dictionaries. Everything is a Spark reader; no driver-side
directory walk."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bounded_broadcast, materialise

# characters of which a deck name must hold one when ``require_special``
SPECIAL_NAME_CHARS = "(~$)_#-"


def _root_uri(spark: SparkSession, path: str) -> str:
    """Spark's rendering of a folder path; one without a scheme belongs to the
    session's default file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def _file_name(path_col: F.Column) -> F.Column:
    return F.regexp_extract(path_col, r"([^/]*)$", 1)


def scan_documents(spark: SparkSession, path: str, glob: str | None = None,
                   ignore_corrupt: bool = False) -> DataFrame:
    """Every file below ``path`` (recursively), optionally filtered by a
    file-name glob: ``(path, modificationTime, length, content)``. Real
    files only; the path is the key. An unreadable file fails the read; with
    ``ignore_corrupt`` it is left out instead."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    return r.load(path)


def scan_slides(spark: SparkSession, path: str, require_special: bool = False) -> DataFrame:
    """``.pptx`` files in any folder below ``path`` (files directly in
    ``path`` are not taken). With ``require_special`` the name must hold one
    of ``( ~ $ ) _ # -``; each file is read once."""
    df = scan_documents(spark, path, "*.pptx")
    root = re.escape(_root_uri(spark, path))
    df = df.filter(~F.col("path").rlike(f"^{root}/[^/]+$"))
    if require_special:
        df = df.filter(_file_name(F.col("path")).rlike("[" + re.escape(SPECIAL_NAME_CHARS) + "]"))
    return df


def read_lines(spark: SparkSession, path: str, line_sep: str | None = None, where: F.Column | None = None) -> DataFrame:
    """Text lines ``(file, block_start, row_id, line)``. Order within a
    file is ``(block_start, row_id)``: the split's offset, then the row's
    position in its task (``monotonically_increasing_id`` grows along a
    split). Files are split across tasks as usual; no task sees a whole
    large file. ``line_sep=None`` ends lines at ``\n``, ``\r\n`` or
    ``\r``, as Python's text reading does. ``where`` chooses files by their
    ``_metadata``."""
    r = spark.read.format("text")
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    df = r.load(path)
    if where is not None:
        df = df.where(where)
    return df.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value").alias("line"),
    )


def _split_offsets(lines: DataFrame) -> DataFrame:
    """Per split: first row id and line offset within its file (a running sum
    over the small per-split table: one row per split)."""
    from pyspark.sql import Window

    splits = lines.groupBy("file", "block_start").agg(F.count(F.lit(1)).alias("_n"),
                                                      F.min("row_id").alias("_first"),
                                                      F.sum(F.octet_length("line")).alias("_bytes"))
    w = Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))


def number_lines(lines: DataFrame) -> DataFrame:
    """0-based ``line_no`` per file from the ``read_lines`` order, without
    putting a file in one task: the ids of one split are consecutive, so a
    line's number is its split's offset in the file plus its distance to the
    split's first id."""
    offsets = _split_offsets(lines).select("file", "block_start", "_first", "_offset")
    out = lines.join(offsets, ["file", "block_start"])
    return out.select("file", (F.col("_offset") + F.col("row_id") - F.col("_first")).cast("bigint").alias("line_no"),
                      "line")


#: Diff of a file's length from its lines' bytes and one separator each, if
#: the last line is terminated: none, or the byte order mark that is not read.
TERMINATED_EXCESS = (0, 3)
#: Files of these endings are read decompressed, so their length tells nothing.
COMPRESSED = {".gz": "gzip", ".bz2": "bz2"}


def _ends_of_compressed(files: DataFrame) -> DataFrame:
    """``(path, _term)`` for compressed files: whether the text is empty or ends
    in a newline. One file is decompressed in pieces in one task, as such a file
    is never split by the text reader either."""
    endings = dict(COMPRESSED)

    def run(batches):
        import importlib
        import io

        import pandas as pd

        for pdf in batches:
            terms = []
            for path, content in zip(pdf["path"], pdf["content"]):
                opener = importlib.import_module(endings["." + path.rsplit(".", 1)[-1].lower()]).open
                last = b"\n"
                with opener(io.BytesIO(content)) as f:
                    while piece := f.read(1 << 20):
                        last = piece[-1:]
                terms.append(last in (b"\n", b"\r"))
            yield pd.DataFrame({"path": pdf["path"], "_term": terms})

    return files.mapInPandas(run, "path string, _term boolean")


#: Files of at most this length are read whole.
WHOLE_FILE_BYTES = 8 << 20
#: Partitions of a scan of whole files that one task reads: the scan counts a
#: file as 4 MB at least, so each has a few files, however short they are.
PARTITIONS_OF_A_TASK = 32
#: Text that is cut into lines at once, or one file.
CUT_BYTES = 4 << 20
_BOM = b"\xef\xbb\xbf"


def _in_fewer_tasks(files: DataFrame) -> DataFrame:
    n = files.rdd.getNumPartitions()
    return files.coalesce(max(1, -(-n // PARTITIONS_OF_A_TASK), min(n, 4 * files.sparkSession.sparkContext.defaultParallelism)))


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(file, passage_no, passage)`` of whole files ``(file, content)``, in the
    bytes that they have."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("content")).to_numpy(), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + CUT_BYTES, side="right")))
            part, first = batch.slice(first, last - first), last
            text = part.column("content").cast(pa.large_binary())
            marked = pc.starts_with(text, _BOM)
            if pc.any(marked).as_py():
                text = pc.if_else(marked, pc.binary_replace_slice(text, 0, len(_BOM), b""), text)
            for end in (b"\r\n", b"\r"):
                text = pc.replace_substring(text, end, b"\n")
            cut = pc.split_pattern(text, b"\n")
            of, lines = pc.list_parent_indices(cut), cut.flatten()
            number = np.arange(len(lines)) - np.searchsorted(of.to_numpy(), of.to_numpy())
            lines = pc.cast(lines, options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))
            yield pa.RecordBatch.from_arrays([part.column("file").take(of), pa.array(number, pa.int64()), lines], names=["file", "passage_no", "passage"])


def read_passages(spark: SparkSession, path: str) -> DataFrame:
    """Files split at line ends keeping every empty string, also the
    trailing one: ``(file, passage_no, passage)``. ``\n``, ``\r\n`` and
    ``\r`` end a line, as in Python's text reading; a byte order mark is not
    part of the text.

    Files of up to ``WHOLE_FILE_BYTES`` are read whole in one scan, many of them
    in a task, and cut where they are read; nothing is shuffled. If there are
    longer or compressed ones, these are read by their lines (see
    ``_split_passages``). Spark's file listing skips zero-length files, so an
    empty file yields no passage (the original yields one empty one)."""
    return _file_passages(spark, path, scan_documents(spark, path))


def _file_passages(spark: SparkSession, path: str, files: DataFrame, named: list[str] | None = None) -> DataFrame:
    """``read_passages`` of the listing ``files`` or, with ``named``, of these files of it."""
    file = F.col("_metadata.file_path")
    if named is not None:
        files = files.filter(file.isin(named))
    # of the listing alone: the other files are not opened
    whole = ~F.lower(file).rlike(_COMPRESSED) & (F.col("_metadata.file_size") <= WHOLE_FILE_BYTES)
    texts = _in_fewer_tasks(files.filter(whole).select(file.alias("file"), "content"))
    passages = texts.mapInArrow(_cut_texts, "file string, passage_no bigint, passage string")
    if files.filter(~whole).select("length").isEmpty():
        return passages
    return passages.unionByName(_split_passages(spark, path, named))


#: Most files that stand in a filter.
MAX_NAMED_FILES = 1000


def read_folder_passages(spark: SparkSession, path: str) -> DataFrame:
    """``read_passages`` of what ``write_per_document`` wrote: the part files of a
    folder follow each other by name and are one text. Passages are numbered in
    it, ``file`` is the part that holds them, and the empty passage after the last
    line end of a part belongs to the last part only. Few folders have more than
    one part; they are told by the listing, and their parts alone are read once
    more to count their passages."""
    files = scan_documents(spark, path)
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1).alias("folder")
    listed = _in_fewer_tasks(files.select(F.col("_metadata.file_path").alias("file")))
    several = listed.groupBy(folder).agg(F.collect_list("file").alias("files")).where(F.size("files") > 1)
    parts = materialise(several.select(F.explode("files").alias("file")), "part-files")
    few = [r["file"] for r in parts.limit(MAX_NAMED_FILES + 1).collect()]
    passages = _file_passages(spark, path, files)
    if not few:
        return passages
    cut = _file_passages(spark, path, files, few) if len(few) <= MAX_NAMED_FILES else passages.join(parts, "file", "left_semi")
    counts = cut.groupBy("file").agg(F.count(F.lit(1)).alias("_n")).select("file", "_n", folder)
    w = Window.partitionBy("folder").orderBy("file")
    before = F.coalesce(F.sum(F.col("_n") - 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    of_parts = bounded_broadcast(materialise(counts.select("file", "_n", before, F.lead("file").over(w).isNotNull().alias("_more")), "part-offsets"))
    return (passages.join(of_parts, "file", "left").where(F.col("_more").isNull() | ~F.col("_more") | (F.col("passage_no") < F.col("_n") - 1))
            .select("file", (F.col("passage_no") + F.coalesce("_before", F.lit(0))).alias("passage_no"), "passage"))


_COMPRESSED = "[.](" + "|".join(e[1:] for e in COMPRESSED) + ")$"


def _split_passages(spark: SparkSession, path: str, named: list[str] | None = None) -> DataFrame:
    """``read_passages`` of long and compressed files.

    Lines are read split-parallel; a file that ends in a line end (or is empty)
    gets one more, empty, passage. Whether it does is told by its length in the
    listing: the bytes of its ``\n`` lines plus one per separator equal the
    length (less a byte order mark) exactly when the last line is terminated, or
    that line ends in ``\r``. Gzip and bzip2 files, which no reader splits, are
    decompressed once more for it."""
    wanted = F.lower("_metadata.file_path").rlike(_COMPRESSED) | (F.col("_metadata.file_size") > WHOLE_FILE_BYTES)
    chosen = F.lit(True) if named is None else F.col("_metadata.file_path").isin(named)
    wanted = wanted & chosen
    numbered = number_lines(read_lines(spark, path, where=wanted)).select(
        "file", F.col("line_no").alias("passage_no"), F.col("line").alias("passage"))
    n_lines = numbered.groupBy("file").agg(F.count(F.lit(1)).alias("_n"))
    raw = read_lines(spark, path, line_sep="\n", where=wanted)
    ends = raw.groupBy("file").agg(
        F.count(F.lit(1)).alias("_raw_n"), F.sum(F.octet_length("line")).alias("_bytes"),
        F.max_by(F.col("line").endswith("\r"), F.struct("block_start", "row_id")).alias("_cr"))
    listing = _in_fewer_tasks(scan_documents(spark, path).filter(chosen & (F.col("length") > WHOLE_FILE_BYTES)).select("path", "length"))
    zipped = scan_documents(spark, path, "*.{gz,GZ,bz2,BZ2}").filter(chosen).select("path", "content")
    # the text reader names files like the listing, but the paths can differ in form
    norm = lambda c: F.regexp_replace(c, "^file:(//)?", "file:")
    excess = F.col("length") - F.coalesce(F.col("_bytes"), F.lit(0)) - F.coalesce(F.col("_raw_n"), F.lit(0))
    plain_ends = (listing.filter(~F.lower("path").rlike(_COMPRESSED)).join(ends, norm(F.col("path")) == norm(F.col("file")), "left")
                  .select("path", (excess.isin(*TERMINATED_EXCESS) | F.coalesce(F.col("_cr"), F.lit(False))).alias("_term")))
    terminated = plain_ends.unionByName(_ends_of_compressed(zipped)).filter("_term")
    trailing = terminated.join(n_lines, norm(F.col("path")) == norm(F.col("file")), "left").select(
        F.coalesce("file", "path").alias("file"), F.coalesce("_n", F.lit(0)).cast("bigint").alias("passage_no"),
        F.lit("").alias("passage"))
    return numbered.unionByName(trailing)


PAGE_RECORD = T.StructType([
    T.StructField("page_text", T.ArrayType(T.StringType())),
    T.StructField("line_format", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("fonts", T.ArrayType(T.StringType())),
        T.StructField("sizes", T.ArrayType(T.DoubleType())),
    ]))),
    T.StructField("text_from_images", T.ArrayType(T.StringType())),
    T.StructField("text_from_tables", T.ArrayType(T.StringType())),
    T.StructField("page_content", T.ArrayType(T.StringType())),
])
PAGE_DICT_LINE = T.MapType(T.StringType(), T.MapType(T.StringType(), PAGE_RECORD))


def read_page_dict(spark: SparkSession, path: str) -> DataFrame:
    """Page dictionaries written by ``sinks.write_page_dict`` (one JSON
    object ``{file: {"Page_n": record}}`` per line) as page rows
    ``(file, page_key, page_no, record fields..., text)``."""
    raw = spark.read.text(path)
    d = raw.select(F.explode(F.from_json("value", PAGE_DICT_LINE)).alias("file", "pages"))
    p = d.select("file", F.explode("pages").alias("page_key", "rec"))
    return p.select("file", "page_key",
                    F.regexp_extract("page_key", r"^Page_(\d+)$", 1).cast("bigint").alias("page_no"),
                    "rec.*").withColumn("text", F.array_join("page_content", ""))


def read_page_dict_positional(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S7 for the positional layout ``{file: {"Page_n": [page_text,
    line_format, text_from_images, text_from_tables, page_content]}}``:
    ``(file, page_key, page_no, the five fields..., text)``. ``line_format``
    holds each entry's JSON text, since its entries are lists of mixed kinds
    or single words. With ``multi_line=False`` each line is an object of its
    own (one file a line, say), so the input splits."""
    schema = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(T.StringType())))
    raw = spark.read.text(path, wholetext=multi_line)
    d = raw.select(F.explode(F.from_json("value", schema)).alias("file", "pages"))
    p = d.select("file", F.explode("pages").alias("page_key", "rec"))
    fields = [F.from_json(F.get(F.col("rec"), i), T.ArrayType(T.StringType())).alias(f.name)
              for i, f in enumerate(PAGE_RECORD.fields)]
    return p.select("file", "page_key",
                    F.regexp_extract("page_key", r"^Page_(\d+)$", 1).cast("bigint").alias("page_no"),
                    *fields).withColumn("text", F.array_join("page_content", ""))
