"""File stores as Python tasks reach them (local folders and every store that
pyarrow opens by URI: hdfs, s3, gs, abfs). Stores that only Spark's own readers
can open (viewfs, say) go through ``sources.files.scan_documents``."""

from __future__ import annotations

from pyarrow import fs as pafs


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified path, and the path in it."""
    if uri.startswith("file:"):
        path = uri[len("file:"):]
        return pafs.LocalFileSystem(), "/" + path.lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri
