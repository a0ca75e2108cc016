"""S1-S4 and F6 as a data source: text shapes of slide decks, read in place.

``sifter_decks`` lists a folder once, packs its decks into partitions by their
bytes (as Spark packs files) and reads each deck through a seekable stream:
only the parts of the zip that hold slide text are fetched, so pictures and
films cost nothing and a deck may be larger than a row can be. A deck that
can't be read is one row with ``error`` set and no text.

Memory: one deck's text. Reading is stateless, so a lost task is read again.
"""

from __future__ import annotations

import posixpath

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import SPECIAL_NAME_CHARS, _root_uri
from .slides import SHAPE_SCHEMA, deck_shapes
from .storage import open_store

DECK_ENDING = ".pptx"
#: What opening a file costs, in bytes; small decks share a partition by it.
OPEN_COST = 4 << 20
DEFAULT_PARTITION_BYTES = 128 << 20


class Decks(InputPartition):
    """(file, path in the store) of the decks of one partition."""

    def __init__(self, files: list[tuple[str, str]]):
        super().__init__(None)
        self.files = files


def pack(files: list[tuple[str, str, int]], limit: int, open_cost: int = OPEN_COST) -> list[list[tuple[str, str]]]:
    """Files (name, path, bytes) in order into groups of at most ``limit``
    bytes with the cost of opening; a larger file is a group of its own."""
    groups: list[list[tuple[str, str]]] = []
    room = 0
    for name, path, size in files:
        cost = size + open_cost
        if not groups or cost > room:
            groups.append([])
            room = limit
        groups[-1].append((name, path))
        room -= cost
    return groups


class DeckReader(DataSourceReader):
    def __init__(self, uri: str, require_special: bool, limit: int):
        self.uri, self.require_special, self.limit = uri.rstrip("/"), require_special, limit

    def decks(self) -> list[tuple[str, str, int]]:
        """(file, path, bytes) of the decks in folders below the root, by path."""
        store, root = open_store(self.uri)
        root = root.rstrip("/")
        found = []
        for info in store.get_file_info(pafs.FileSelector(root, recursive=True)):
            folder, name = posixpath.split(info.path)
            if info.type != pafs.FileType.File or not name.endswith(DECK_ENDING) or folder == root:
                continue
            if self.require_special and not any(c in name for c in SPECIAL_NAME_CHARS):
                continue
            found.append((self.uri + info.path[len(root):], info.path, info.size))
        return sorted(found)

    def partitions(self) -> list[Decks]:
        return [Decks(g) for g in pack(self.decks(), self.limit)] or [Decks([])]

    def read(self, partition: Decks):
        schema = pa.schema([("file", pa.string()), ("slide_no", pa.int64()), ("shape_ix", pa.int64()), ("text", pa.string()), ("error", pa.string())])
        store, _ = open_store(self.uri)
        for file, path in partition.files:
            try:
                with store.open_input_file(path) as f:
                    rows = [(file, slide, ix, text, None) for slide, ix, text in deck_shapes(f)]
            except Exception as e:  # noqa: BLE001 - any unreadable deck is a row of its own (S4)
                rows = [(file, None, None, None, f"{type(e).__name__}: {e}")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class DeckSource(DataSource):
    """Source ``sifter_decks``; options ``path``, ``requireSpecial``,
    ``maxPartitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "sifter_decks"

    def schema(self):
        return SHAPE_SCHEMA

    def reader(self, schema) -> DeckReader:
        o = self.options
        return DeckReader(o["path"], o.get("requireSpecial", "false").lower() == "true", int(o.get("maxPartitionBytes", DEFAULT_PARTITION_BYTES)))


def read_decks(spark: SparkSession, path: str, require_special: bool = False, partition_bytes: int = DEFAULT_PARTITION_BYTES) -> DataFrame:
    """``(file, slide_no, shape_ix, text, error)`` of every deck in the folders
    below ``path``. With ``require_special`` the name must hold one of
    ``( ~ $ ) _ # -``; each deck is read once."""
    spark.dataSource.register(DeckSource)
    return (spark.read.format(DeckSource.name()).option("path", _root_uri(spark, path)).option("requireSpecial", str(require_special))
            .option("maxPartitionBytes", str(partition_bytes)).load())
