"""K1 as the original writes it: one text file per document, named by the row.

Spark's text writer names its files itself, so a folder per document is all it
can do. Here a data source writer makes the files:

* rows come sorted by (name, order) and are streamed into one open file at a
  time, so a task holds one batch whatever the size of a document;
* **task**: an attempt writes to a folder of its own and moves its finished files
  to the job's staging folder when all rows are written. A lost attempt leaves
  nothing but its folder; a second attempt (retry or speculation) moves files of
  the same names and contents over those of the first;
* **job**: the staging folder is renamed to the target, with ``_SUCCESS`` in it.
  Until then readers see the old target or none. A job that fails removes its
  staging folder.

A document is one file and so one stream of one task; documents are dealt to
tasks by the hash of their names.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import ensure_checkpoint_dir
from ..sources.files import _root_uri
from ..sources.storage import open_store

#: Characters that a file name can't hold, or that would hide the file when they
#: stand first, with their escapes ("%" itself first).
_ANYWHERE = [("%", "%25"), ("/", "%2F"), ("\\", "%5C"), ("\0", "%00"), (":", "%3A"), ("\n", "%0A"), ("\r", "%0D")]
_FIRST = [(".", "%2E"), ("_", "%5F")]

#: Bytes of a piece held at once by the task that joins the pieces of a file.
PIECE_BYTES = 4 << 20


def file_name(key: Column, suffix: str = ".txt") -> Column:
    """File name of a document key: the key as text with the few characters
    escaped that a name can't hold; different keys keep different names. A null
    key is named like an empty one."""
    name = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(suffix))
    for char, escape in _ANYWHERE:
        name = F.replace(name, F.lit(char), F.lit(escape))
    for char, escape in _FIRST:
        name = F.when(F.startswith(name, F.lit(char)), F.concat(F.lit(escape), F.substr(name, F.lit(2)))).otherwise(name)
    return name


#: Characters that Spark escapes in the names of partition folders, "%" first.
_IN_FOLDERS = "%" + "".join(map(chr, range(1, 32))) + "\"#'*/:=?\\\x7f{[]^"
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def folder_name(column: str, key: Column) -> Column:
    """``column=key``, the folder that ``partitionBy(column)`` writes a key to."""
    text = name = key.cast("string")
    for char in _IN_FOLDERS:
        name = F.replace(name, F.lit(char), F.lit(f"%{ord(char):02X}"))
        column = column.replace(char, f"%{ord(char):02X}")
    odd = F.length(F.translate(text, _IN_FOLDERS, "")) < F.length(text)
    return F.concat(F.lit(f"{column}="), F.when(text.isNull() | (text == ""), _NO_KEY).when(odd, name).otherwise(text))


def document_key(name: Column, suffix: str = ".txt") -> Column:
    """The key that ``file_name`` made ``name`` from."""
    for char, escape in [*_FIRST, *reversed(_ANYWHERE)]:
        name = F.replace(name, F.lit(escape), F.lit(char))
    return F.left(name, F.length(name) - len(suffix))


@dataclass
class _Written(WriterCommitMessage):
    files: int
    bytes: int


class _FilesWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, overwrite: bool):
        self.uri, self.overwrite = uri, overwrite
        self.job = uuid.uuid4().hex

    def _places(self) -> tuple[pafs.FileSystem, str, str]:
        """The store, the target and the job's staging folder beside it."""
        store, target = open_store(self.uri)
        folder, base = posixpath.split(target.rstrip("/"))
        return store, target.rstrip("/"), f"{folder}/_staging-{base}-{self.job}"

    def write(self, iterator):
        store, _, staging = self._places()
        attempt = f"{staging}/attempt-{uuid.uuid4().hex}"
        store.create_dir(attempt, recursive=True)
        name, out, names, size = None, None, [], 0
        try:
            for batch in iterator:
                for row_name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if row_name != name:
                        if row_name is None or name is not None and row_name < name:
                            raise ValueError(f"rows must be sorted by file name: {row_name!r} after {name!r}")
                        if out is not None:
                            out.close()
                        if "/" in row_name:
                            store.create_dir(posixpath.dirname(f"{attempt}/{row_name}"), recursive=True)
                        name, out = row_name, store.open_output_stream(f"{attempt}/{row_name}")
                        names.append(name)
                    if content.is_valid:
                        data = content.as_buffer()
                        out.write(data)
                        size += data.size
        finally:
            if out is not None:
                out.close()
        done = f"{staging}/files"
        store.create_dir(done, recursive=True)
        moved = set()
        for name in names:
            place, folder = f"{done}/{name}", posixpath.dirname(name)
            if folder in moved:
                continue
            # a folder of this task alone moves at once; names are sorted, so only the first and last may be others' too
            if folder not in ("", posixpath.dirname(names[0]), posixpath.dirname(names[-1])) and store.get_file_info(f"{done}/{folder}").type == pafs.FileType.NotFound:
                try:
                    store.move(f"{attempt}/{folder}", f"{done}/{folder}")
                    moved.add(folder)
                    continue
                except OSError:  # the store moves files only
                    pass
            if folder:
                store.create_dir(posixpath.dirname(place), recursive=True)
            if store.get_file_info(place).type != pafs.FileType.NotFound:
                store.delete_file(place)
            store.move(f"{attempt}/{name}", place)
        store.delete_dir(attempt)
        return _Written(len(names), size)

    def commit(self, messages):
        store, target, staging = self._places()
        done = f"{staging}/files"
        store.create_dir(done, recursive=True)
        exists = store.get_file_info(target).type == pafs.FileType.Directory
        if exists and not self.overwrite:
            for info in store.get_file_info(pafs.FileSelector(done)):
                store.move(info.path, f"{target}/{info.base_name}")
        else:
            if exists:
                store.delete_dir(target)
            store.create_dir(posixpath.dirname(target), recursive=True)
            store.move(done, target)
        store.open_output_stream(f"{target}/_SUCCESS").close()
        store.delete_dir(staging)

    def abort(self, messages):
        store, _, staging = self._places()
        if store.get_file_info(staging).type == pafs.FileType.Directory:
            store.delete_dir(staging)


class NamedFiles(DataSource):
    """Sink ``sifter_files``: rows (name, content binary), sorted by name in
    each partition, every name in one partition. A name may hold folders where
    the whole target is overwritten."""

    @classmethod
    def name(cls) -> str:
        return "sifter_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool):
        return _FilesWriter(self.options["path"], overwrite)


def write_files(rows: DataFrame, path: str, name_col: str = "name", content_col: str = "content",
                order: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Rows into files named by ``name_col``; the contents (text or binary) of
    one name follow each other by ``order``. ``mode``: ``overwrite`` replaces the
    folder at the end of the job, ``append`` adds files to it."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    (rows.select(F.col(name_col).alias("name"), *order, F.col(content_col).cast("binary").alias("content"))
     .repartition("name").sortWithinPartitions("name", *order).select("name", "content")
     .write.format(NamedFiles.name()).mode(mode).option("path", _root_uri(spark, path)).save())


def write_folders(rows: DataFrame, path: str, column: str, order: Sequence[str] = (), text_col: str = "text") -> None:
    """A folder ``column=key`` for each key, as ``partitionBy(column).text`` writes
    it: the key's texts by ``order``, a newline after each (a null is an empty
    line). Rows are range partitioned, so a large key spans several tasks, whose
    part files follow each other. The files are made by a task and named at its
    end; the job ends with one rename, however many folders there are."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    folder = F.concat(folder_name(column, F.col(column)), F.lit("/")).alias("_folder")
    content = F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n")).cast("binary").alias("_content")
    name = F.concat("_folder", F.format_string("part-%05d.txt", F.spark_partition_id())).alias("name")
    (rows.select(folder, *order, content).repartitionByRange("_folder", *order).sortWithinPartitions("_folder", *order)
     .select(name, F.col("_content").alias("content"))
     .write.format(NamedFiles.name()).mode("overwrite").option("path", _root_uri(spark, path)).save())


def write_one_file(rows: DataFrame, path: str, name: str, order: Sequence[str], content_col: str = "content") -> None:
    """The contents of all rows, by ``order``, as one file ``path/name``. All
    tasks sort and write pieces of it; one task then streams the pieces into the
    file, a few megabytes at a time, so none sorts or holds the whole."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    pieces = _root_uri(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/sifter-files/pieces-{uuid.uuid4().hex}")
    # range partitions follow each other in order, as their numbers do
    (rows.select(*order, F.col(content_col).cast("binary").alias("content")).repartitionByRange(*order).sortWithinPartitions(*order)
     .select(F.format_string("%08d", F.spark_partition_id()).alias("name"), "content")
     .write.format(NamedFiles.name()).mode("overwrite").option("path", pieces).save())

    def stream(batches):
        for _ in batches:
            store, folder = open_store(pieces)
            files = [i for i in store.get_file_info(pafs.FileSelector(folder)) if not i.base_name.startswith("_")]
            for info in sorted(files, key=lambda i: i.base_name):
                with store.open_input_stream(info.path) as piece:
                    while data := piece.read(PIECE_BYTES):
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], names=["name", "content"])

    (spark.range(0, 1, 1, 1).mapInArrow(stream, "name string, content binary")
     .write.format(NamedFiles.name()).mode("overwrite").option("path", _root_uri(spark, path)).save())


def write_document_files(pages: DataFrame, path: str, file_col: str = "doc_id", order: Sequence[str] = ("page_no",),
                         text_col: str = "text", mode: str = "overwrite") -> None:
    """K1: ``<document>.txt`` for each document: its page texts in page order, a
    newline after each. A null text is an empty page."""
    rows = pages.select(file_name(F.col(file_col)).alias("name"), *order,
                        F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n")).alias("content"))
    write_files(rows, path, order=order, mode=mode)
