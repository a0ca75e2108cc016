"""Page assembly from layout elements, and nesting of pages and slides.

Input: one row per layout element ``(file keys..., page_no, elem_ix, y1, kind,
text, table, chars)`` as a layout parser emits it. All per-page work shares
one hash partitioning on ``(file, page)``: the reading-order window and the
page aggregate run in the same stage after a single exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tables import page_key, page_text, table_to_text

TEXT, FIGURE, RECT = "text", "figure", "rect"
KINDS = (TEXT, FIGURE, RECT)
IMAGE_PLACEHOLDER, TABLE_PLACEHOLDER = "image", "table"


def _page_window(page_keys: Sequence[str]) -> Window:
    return Window.partitionBy(*page_keys)


def order_elements(el: DataFrame, page_keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """L1: ``ord`` = reading position, top edge ``y1`` descending; ties keep
    the input order (``elem_ix``)."""
    w = _page_window(page_keys).orderBy(F.col("y1").desc(), F.col("elem_ix").asc())
    return el.withColumn("ord", (F.row_number().over(w) - 1).cast("int"))


def classify(el: DataFrame) -> DataFrame:
    """L2: keep the three handled kinds; every other kind is ignored."""
    return el.filter(F.col("kind").isin(*KINDS))


def text_formats(chars: Column) -> tuple[Column, Column]:
    """L3: sorted distinct font names and sizes of an element's characters."""
    fonts = F.array_sort(F.array_distinct(F.transform(chars, lambda c: c["font"])))
    sizes = F.array_sort(F.array_distinct(F.transform(chars, lambda c: c["size"])))
    return fonts, sizes


def mark_table_suppression(el: DataFrame, page_keys: Sequence[str] = ("doc_id", "page_no"),
                           n_tables: Column | None = None) -> DataFrame:
    """L4 (needs ``ord``). On a page with at least one detected table, text
    before the first rectangle is kept, table 0 is emitted at that rectangle,
    and everything textual after it is dropped; figures are never dropped.
    Adds ``first_rect``, ``n_tables``, ``keep`` and ``emits_table``.

    ``n_tables`` defaults to the page's rectangles that carry a table."""
    w = _page_window(page_keys)
    first_rect = F.min(F.when(F.col("kind") == RECT, F.col("ord"))).over(w)
    n_tab = n_tables if n_tables is not None else F.count(F.when(F.col("kind") == RECT, F.col("table"))).over(w)
    el = el.withColumn("first_rect", first_rect).withColumn("n_tables", n_tab.cast("int"))
    has_tables = (F.col("n_tables") > 0) & F.col("first_rect").isNotNull()
    emits = (F.col("kind") == RECT) & has_tables & (F.col("ord") == F.col("first_rect"))
    keep = (
        F.when(F.col("kind") == FIGURE, True)
        .when(F.col("kind") == TEXT, ~has_tables | (F.col("ord") < F.col("first_rect")))
        .otherwise(emits)
    )
    return el.withColumn("keep", keep).withColumn("emits_table", emits)


def _table_0(page_keys: Sequence[str]) -> Column:
    """The page's first detected table in reading order."""
    has_table = (F.col("kind") == RECT) & F.col("table").isNotNull()
    return F.min_by("table", F.when(has_table, F.col("ord"))).over(_page_window(page_keys))


def mark_tables(el: DataFrame, page_keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """L4 for pages with several tables (needs ``ord``; other kinds than text,
    figure and rectangle are passed over).

    The rectangles of a page, in reading order, fall into regions: a rectangle
    goes on with the region before it if no other element stands between them, or
    if it lies in the extent of an earlier rectangle (its top edge is above the
    lowest lower edge so far; ``table_y0`` is the lower edge of the table detected
    at a rectangle, null if it has none). The n-th region takes the page's n-th
    table, shown at its first rectangle; a region beyond the number of tables
    shows nothing. Text whose top edge lies in the extent of a region that has a
    table is part of the table and dropped; all other text, and every figure,
    stays.

    Adds ``region`` (of a rectangle, from 0), ``n_tables``, ``keep`` and
    ``emits_table``. All windows share one partitioning and one order."""
    handled, rect = F.col("kind").isin(*KINDS), F.col("kind") == RECT
    if "table_y0" not in el.columns:
        el = el.withColumn("table_y0", F.lit(None).cast("double"))
    page = _page_window(page_keys)
    order = page.orderBy("ord")
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lowest = F.min(F.when(rect, F.col("table_y0"))).over(above)
    last_kind = F.last(F.when(handled, F.col("kind")), ignorenulls=True).over(above)
    inside = F.coalesce(F.col("y1") > lowest, F.lit(False))
    starts = rect & ~inside & F.coalesce(last_kind != RECT, F.lit(True))
    el = el.withColumn("_starts", starts)
    el = el.withColumn("region", F.when(rect, F.sum(F.col("_starts").cast("int")).over(upto) - 1))
    el = el.withColumn("n_tables", F.count(F.when(rect, F.col("table"))).over(page).cast("int"))
    shown = F.col("region") < F.col("n_tables")
    covered = F.coalesce(F.col("y1") > F.min(F.when(rect & shown, F.col("table_y0"))).over(above), F.lit(False))
    emits = F.col("_starts") & shown
    keep = F.when(F.col("kind") == FIGURE, True).when(F.col("kind") == TEXT, ~covered).otherwise(emits)
    return el.withColumn("emits_table", F.coalesce(emits, F.lit(False))).withColumn(
        "keep", F.coalesce(keep, F.lit(False))).drop("_starts")


def entries(el: DataFrame, page_keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """One entry per element with ``keep`` and the parts it contributes (L5, L6):
    ``part_text`` (page_text), ``fmt_kind``/``fonts``/``sizes`` (line_format)
    and ``content`` (page_content)."""
    el = el.withColumn("_table_0", _table_0(page_keys))
    return _entries(el, page_keys, table_to_text(F.col("_table_0")))


def _entries(el: DataFrame, page_keys: Sequence[str], table_text: Column, *more: str) -> DataFrame:
    fonts, sizes = (F.col("_fonts"), F.col("_sizes")) if "_fonts" in el.columns else text_formats(F.col("chars"))
    kind = F.col("kind")
    return el.select(
        *page_keys, "ord", "kind", "keep",
        F.when(kind == TEXT, F.col("text")).when(kind == FIGURE, F.lit(IMAGE_PLACEHOLDER))
        .otherwise(F.lit(TABLE_PLACEHOLDER)).alias("part_text"),
        F.when(kind == TEXT, F.lit("text")).when(kind == FIGURE, F.lit(IMAGE_PLACEHOLDER))
        .otherwise(F.lit(TABLE_PLACEHOLDER)).alias("fmt_kind"),
        F.when(kind == TEXT, fonts).otherwise(F.array().cast("array<string>")).alias("fonts"),
        F.when(kind == TEXT, sizes).otherwise(F.array().cast("array<double>")).alias("sizes"),
        F.when(kind == RECT, table_text).otherwise(F.col("text")).alias("content"), *more,
    )


def assemble_pages(el: DataFrame, page_keys: Sequence[str] = ("doc_id", "page_no"), multi_table: bool = False) -> DataFrame:
    """One record per page with the five ordered arrays
    ``page_text, line_format, text_from_images, text_from_tables,
    page_content``. Every page that has any element, of whatever kind, gets a
    record (possibly with empty arrays). With ``multi_table`` a page shows all
    its tables and the text between them (see ``mark_tables``)."""
    page_keys = list(page_keys)
    # the distinct fonts and sizes move and are sorted, not a record a character
    fonts, sizes = (F.when(F.col("kind") == TEXT, c) for c in text_formats(F.col("chars")))
    el = el.withColumns({"_fonts": fonts, "_sizes": sizes}).drop("chars")
    # an element of another kind is never kept, but its page has a record
    ordered = order_elements(el, page_keys)
    # collect only the kept entries (collect_list skips nulls), so a page whose
    # elements were all dropped still gets a record with empty arrays; the
    # aggregate reuses the window's partitioning on the page key
    columns = ["ord", "kind", "part_text", "fmt_kind", "fonts", "sizes", "content"]
    if multi_table:
        # a region's table is looked up among the page's tables once the page is whole
        ent = _entries(mark_tables(ordered, page_keys), page_keys, F.lit(None).cast("string"), "region", "table")
        tables = F.array_sort(F.collect_list(F.when((F.col("kind") == RECT) & F.col("table").isNotNull(), F.struct("ord", "table"))))
        pages = ent.groupBy(*page_keys).agg(F.array_sort(F.collect_list(F.when(F.col("keep"), F.struct(*columns, "region")))).alias("_e"),
                                            tables.alias("_t"))
        pages = pages.withColumn("_e", F.transform("_e", lambda x: F.when(x["kind"] == RECT, x.withField(
            "content", table_to_text(F.get(F.col("_t"), x["region"])["table"]))).otherwise(x)))
    else:
        ent = entries(mark_table_suppression(ordered, page_keys), page_keys)
        pages = ent.groupBy(*page_keys).agg(F.array_sort(F.collect_list(F.when(F.col("keep"), F.struct(*columns)))).alias("_e"))
    return pages.select(
        *page_keys,
        F.transform("_e", lambda x: x["part_text"]).alias("page_text"),
        F.transform("_e", lambda x: F.struct(x["fmt_kind"].alias("kind"), x["fonts"].alias("fonts"),
                                             x["sizes"].alias("sizes"))).alias("line_format"),
        F.transform(F.filter("_e", lambda x: x["kind"] == FIGURE), lambda x: x["content"]).alias("text_from_images"),
        F.transform(F.filter("_e", lambda x: x["kind"] == RECT), lambda x: x["content"]).alias("text_from_tables"),
        F.transform("_e", lambda x: x["content"]).alias("page_content"),
    )


def with_page_text(pages: DataFrame) -> DataFrame:
    """``page_key`` and the page's text (content concatenated)."""
    return pages.withColumn("page_key", page_key(F.col("page_no"))).withColumn(
        "text", page_text(F.col("page_content")))


# ---------------------------------------------------------------------------
# A4, L11, L12, U1
# ---------------------------------------------------------------------------
def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A4: per key, the row that comes first by ``order`` (deterministic;
    partial aggregation, so a hot key still collapses map-side)."""
    s = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols])).alias("_f")
    return df.groupBy(*keys).agg(s).select(*keys, *[F.col(f"_f.{c}").alias(c) for c in (*order, *cols)])


def nest_pages(pages: DataFrame, file_col: str = "doc_id", value_cols: Sequence[str] = (
        "page_text", "line_format", "text_from_images", "text_from_tables", "page_content"),
        position_col: str | None = None) -> DataFrame:
    """``(file, pages MAP<'Page_n', STRUCT<...>>)``, one dictionary per
    file with its pages in numeric order. Of several records of one page the
    first by ``position_col`` stays (without it: the smallest record). The
    page table is the form for large work; this view holds one file a row."""
    rec = F.struct(*[F.col(c) for c in value_cols])
    first = (F.min_by(rec, position_col) if position_col else F.min(rec)).alias("r")
    one = pages.groupBy(file_col, "page_no").agg(first)
    grouped = one.groupBy(file_col).agg(F.array_sort(F.collect_list(F.struct("page_no", "r"))).alias("_p"))
    return grouped.select(
        file_col,
        F.map_from_entries(F.transform("_p", lambda x: F.struct(page_key(x["page_no"]).alias("key"),
                                                                x["r"].alias("value")))).alias("pages"),
    )


def nest_parts(parts: DataFrame, file_col: str, order: Sequence[str], text_col: str = "text") -> DataFrame:
    """``(file, parts ARRAY<STRING>)`` - a file's shape (or turn) texts in
    slide and shape order, one list per file."""
    packed = F.struct(*[F.col(c) for c in order], F.col(text_col).alias("_t"))
    return parts.groupBy(file_col).agg(
        F.transform(F.array_sort(F.collect_list(packed)), lambda x: x["_t"]).alias("parts"))


def corpus_union(*corpora: DataFrame) -> DataFrame:
    """One corpus over every source, by column name."""
    out = corpora[0]
    for c in corpora[1:]:
        out = out.unionByName(c)
    return out
