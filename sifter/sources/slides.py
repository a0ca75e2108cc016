"""Shape text of slide decks (``.pptx``).

A deck is a zip of XML parts; slide order comes from ``ppt/presentation.xml``
(``sldIdLst``) through its relationships, not from part names. On each slide
the top-level shapes of the shape tree are visited in order; a text shape
(``p:sp``) yields one string - paragraphs joined by ``\\n``, line breaks as
``\\v`` - and pictures, connectors, frames and groups (not descended into) are
skipped. A file that cannot be opened yields one row with ``error`` set and
the job goes on.

Parsing one file is per-row Python (a small helper): Spark distributes the
files across tasks with ``mapInPandas``."""

from __future__ import annotations

import io
import posixpath
import zipfile
from typing import BinaryIO
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NS = {
    "p": "http://schemas.openxmlformats.org/presentationml/2006/main",
    "a": "http://schemas.openxmlformats.org/drawingml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}

SHAPE_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("slide_no", T.LongType()),
    T.StructField("shape_ix", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])


def _paragraph_text(p: ET.Element) -> str:
    out = []
    for child in p:
        tag = child.tag.rsplit("}", 1)[-1]
        if tag in ("r", "fld"):
            t = child.find("a:t", NS)
            out.append(t.text or "" if t is not None else "")
        elif tag == "br":
            out.append("\v")
    return "".join(out)


def slide_paths(z: zipfile.ZipFile) -> list[str]:
    pres = ET.fromstring(z.read("ppt/presentation.xml"))
    rels = ET.fromstring(z.read("ppt/_rels/presentation.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", NS)}
    out = []
    lst = pres.find("p:sldIdLst", NS)
    for sid in (lst if lst is not None else []):
        rid = sid.get(f"{{{NS['r']}}}id")
        if rid in target:
            out.append(posixpath.normpath(posixpath.join("ppt", target[rid])))
    return out


def deck_shapes(content: bytes | BinaryIO) -> list[tuple[int, int, str]]:
    """``(slide_no, shape_ix, text)`` of one deck's text shapes; from its bytes
    or from a seekable stream, of which only the parts needed are read."""
    rows = []
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as z:
        for slide_no, part in enumerate(slide_paths(z)):
            root = ET.fromstring(z.read(part))
            tree = root.find("p:cSld/p:spTree", NS)
            if tree is None:
                continue
            shapes = [c for c in tree if c.tag.rsplit("}", 1)[-1] not in ("nvGrpSpPr", "grpSpPr", "extLst")]
            for ix, sh in enumerate(shapes):
                if sh.tag != f"{{{NS['p']}}}sp":
                    continue
                body = sh.find("p:txBody", NS)
                paras = body.findall("a:p", NS) if body is not None else []
                rows.append((slide_no, ix, "\n".join(_paragraph_text(p) for p in paras)))
    return rows


def extract_slides(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """S3/S4 over a ``binaryFile`` frame: ``(file, slide_no, shape_ix, text,
    error)``; unreadable files give one row with ``error`` and null text."""
    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf[path_col], pdf[content_col]):
                try:
                    for slide_no, ix, text in deck_shapes(bytes(content)):
                        rows.append((path, slide_no, ix, text, None))
                except Exception as e:  # noqa: BLE001 - any unreadable deck is skipped, as logged
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["file", "slide_no", "shape_ix", "text", "error"]).astype(
                {"slide_no": "Int64", "shape_ix": "Int64"})

    return files.select(path_col, content_col).mapInPandas(run, SHAPE_SCHEMA)


def drop_unreadable(shapes: DataFrame) -> DataFrame:
    """Keep the rows of decks that opened."""
    return shapes.filter(F.col("error").isNull()).drop("error")
