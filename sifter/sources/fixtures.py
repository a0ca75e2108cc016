"""Views derived from the driver tables (see FIXTURES.md).

``documents`` rows stand for files, their text lines for layout elements and
corpus lines. Everything here is a narrow transformation of one document row
(``posexplode`` / higher-order functions), so no shuffle is needed to derive
lines, passages or pages at any scale."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import REPLACEMENT_CHAR, clean_retrieval, is_not_blank, strip
from ..session import spread

LINES_PER_PAGE = 8

# The stopword list of the tests.
TEST_STOPWORDS = ["the", "of", "and", "de", "la"]


# row key of each driver table whose scans are spread on it (see ``spread``);
# the query batch too: measured at sf0.1, leaving it unspread was slower.
TABLE_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id", "embeddings": "vec_id",
              "benchmark": "item_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = TABLE_KEYS.get(name)
    return spread(df, [key] if key else None)


def split_lines(text: F.Column) -> F.Column:
    """Split on ``\\n`` keeping empty strings, also a trailing one."""
    return F.split(text, "\n", -1)


def doc_lines(documents: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)``, ``line_no`` 0-based."""
    return documents.select(
        "doc_id", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("bigint"))


def clean_passages(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Strip, apply the retrieval profile and drop blank rows. The cleaned text
    passes through a generator, which the filter is not pushed below: else every
    line were cleaned twice, for the filter and for the row."""
    cleaned = F.explode(F.array(clean_retrieval(strip(F.col(line_col))))).alias("passage")
    return lines.select(*[c for c in lines.columns if c != line_col], cleaned).filter(is_not_blank(F.col("passage")))


def passages(documents: DataFrame) -> DataFrame:
    """``(doc_id, page_no, line_no, passage)``: cleaned, non-blank lines."""
    lines = doc_lines(documents).withColumn("page_no", F.floor(F.col("line_no") / LINES_PER_PAGE).cast("bigint"))
    return clean_passages(lines).select("doc_id", "page_no", "line_no", "passage")


def doc_pages(documents: DataFrame) -> DataFrame:
    """``(doc_id, page_no, page_raw)``: every run of eight lines, joined by
    newlines, built inside the document row (no shuffle)."""
    lines = split_lines(F.col("text"))
    n_pages = F.ceil(F.size(lines) / LINES_PER_PAGE).cast("int")
    pages = F.transform(
        F.sequence(F.lit(0), n_pages - 1),
        lambda p: F.array_join(F.slice(lines, p * LINES_PER_PAGE + 1, LINES_PER_PAGE), "\n"),
    )
    return documents.select("doc_id", F.posexplode(pages).alias("page_no", "page_raw")).withColumn(
        "page_no", F.col("page_no").cast("bigint")
    )


def elements(documents: DataFrame) -> DataFrame:
    """Layout elements ``(doc_id, page_no, elem_ix, y1, kind, text, table, chars)``.

    A line with ``|`` is a rectangle whose detected table is that one row of
    cells (an empty cell is null, a blank in a cell a newline); every eleventh
    line (by ``doc_id + line_no``) is a figure whose recognised text is the
    line, every seventh of the others a curve, a kind that no page text takes;
    the rest are text boxes. Text and figure text end in a newline, as a layout
    parser emits them. The top edges do not follow the input order, and two
    elements at a time share one. Each word is one character record: font = its
    first letter, size = its length."""
    lines = doc_lines(documents)
    kind = (
        F.when(F.col("line").contains("|"), F.lit("rect"))
        .when((F.col("doc_id") + F.col("line_no")) % 11 == 0, F.lit("figure"))
        .when((F.col("doc_id") + F.col("line_no")) % 7 == 0, F.lit("curve"))
        .otherwise(F.lit("text"))
    )
    words = F.filter(F.split(F.col("line"), " ", -1), lambda w: w != "")
    chars = F.transform(
        words,
        lambda w: F.struct(F.substring(w, 1, 1).alias("font"), F.length(w).cast("double").alias("size")),
    )
    cells = F.transform(F.split(F.col("line"), "\\|", -1),
                        lambda c: F.when(c != "", F.replace(c, F.lit(" "), F.lit("\n"))))
    return lines.select(
        "doc_id",
        F.floor(F.col("line_no") / LINES_PER_PAGE).cast("bigint").alias("page_no"),
        (F.col("line_no") % LINES_PER_PAGE).cast("int").alias("elem_ix"),
        (F.lit(800.0) - F.lit(10.0) * F.floor(F.col("line_no") * 3 % LINES_PER_PAGE / 2)).alias("y1"),
        kind.alias("kind"),
        F.when(kind.isin("text", "figure"), F.concat(F.col("line"), F.lit("\n"))).alias("text"),
        F.when(kind == "rect", F.array(cells)).alias("table"),
        chars.alias("chars"),
    )


def table_extents(el: DataFrame) -> DataFrame:
    """``elements`` with ``table_y0``, the lower edge of the table detected at a
    rectangle: by the rectangle's position it covers nothing (null), its own
    height or the one below it too."""
    size = (F.col("doc_id") + F.col("elem_ix")) % 3
    return el.withColumn("table_y0", F.when((F.col("kind") == "rect") & (size > 0), F.col("y1") - 10.0 * size + 5.0))


def deck_bytes(slides: list[list[str]]) -> bytes:
    """A slide deck (zip of XML parts) with the given text shapes on each slide;
    newlines part paragraphs."""
    names = {"p": "presentationml", "a": "drawingml"}
    head = " ".join(f'xmlns:{k}="http://schemas.openxmlformats.org/{v}/2006/main"' for k, v in names.items())
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def shape(text: str) -> str:
        paragraphs = "".join(f"<a:p><a:r><a:t>{escape(p, {chr(13): '&#13;'})}</a:t></a:r></a:p>" for p in text.split("\n"))
        return f"<p:sp><p:txBody>{paragraphs}</p:txBody></p:sp>"

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        ids = "".join(f'<p:sldId id="{256 + i}" r:id="rId{i}"/>' for i in range(len(slides)))
        z.writestr("ppt/presentation.xml", f'<p:presentation {head} xmlns:r="{rel}"><p:sldIdLst>{ids}</p:sldIdLst></p:presentation>')
        z.writestr("ppt/_rels/presentation.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(
            f'<Relationship Id="rId{i}" Target="slides/slide{i + 1}.xml"/>' for i in range(len(slides))) + "</Relationships>")
        for i, shapes in enumerate(slides):
            z.writestr(f"ppt/slides/slide{i + 1}.xml", f"<p:sld {head}><p:cSld><p:spTree>{''.join(map(shape, shapes))}</p:spTree></p:cSld></p:sld>")
    return out.getvalue()


#: Every so-manyth conversation's deck has a plain name, or is cut off half way.
PLAIN_DECKS, CUT_DECKS = 5, 7


def decks(conversations: DataFrame) -> DataFrame:
    """``(name, content)``: a deck for each conversation, a slide for each turn
    with the shapes role and text. Some names hold no special character; some
    decks are cut off."""
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.array(t["role"], t["text"]))
    rows = conversations.groupBy("conv_id").agg(turns.alias("slides"))

    def run(batches):
        for b in batches:
            ids, slides = b.column("conv_id").to_pylist(), b.column("slides").to_pylist()
            contents = [deck_bytes(s) for s in slides]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"conv{i}.pptx" if i % PLAIN_DECKS == 0 else f"conv_{i}.pptx" for i in ids]),
                 pa.array([c[:len(c) // 2] if i % CUT_DECKS == 3 else c for i, c in zip(ids, contents)], pa.binary())],
                names=["name", "content"])

    return rows.mapInArrow(run, "name string, content binary")


def damaged_lines(documents: DataFrame) -> DataFrame:
    """``doc_lines`` with every ``é`` replaced by U+FFFD."""
    return doc_lines(documents).withColumn("line", F.replace(F.col("line"), F.lit("é"), F.lit(REPLACEMENT_CHAR)))


def stopwords_frame(spark: SparkSession, words: list[str] | None = None) -> DataFrame:
    return spark.createDataFrame([(w,) for w in (words or TEST_STOPWORDS)], "word string")
