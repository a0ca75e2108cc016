"""S7 and K5 in the original's layout: one JSON object for a whole corpus,

    {file: {"Page_0": [page_text, line_format, images, tables, page_content], ...}, ...}

usually on a single line, so a line reader gives it to one task.

**Reading in parallel.** The text reader splits at any separator, across split
borders, so the object is cut at ``"Page_``: a piece is a page number, a record
and what follows it. A cut is a real page key exactly if the piece goes on
``<digits>": [`` - the quote that closes the key can't be escaped, a value is never
followed by a colon, and a file key is followed by ``{``. Other cuts (a text that
holds ``"Page_``) are glued back to the piece before them.

What a piece needs from the pieces before it is its file and, if it is no key, the
page it belongs to. Both are running values over the file: inside a split by a
window over the split's rows, across splits by a running value over one row a
split (its number of keys and the last file it opened). So no task sees more than
a split, however large the object is.

**Writing.** All tasks sort the records and write them as text pieces, which stream
into one file by ``sinks.documents.write_one_file``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bounded_broadcast, materialise
from ..sinks.documents import write_one_file
from .files import PAGE_RECORD, read_lines

CUT = '"Page_'
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_KEY = r'^\d+"\s*:\s*\['
#: What can stand between two records: a comma, or the end of a file with any
#: number of files without pages and the start of the next file or the end of all.
_BETWEEN = rf"\s*(?:,\s*|\}}(?:\s*,\s*{_STRING}\s*:\s*\{{\s*\}})*+(?:\s*,\s*{_STRING}\s*:\s*\{{\s*|\s*\}}\s*))"
_PAGE = rf'(?s)^(\d+)"\s*:\s*(\[.*\]){_BETWEEN}$'
_OPENS = rf"(?s)[{{,]\s*({_STRING})\s*:\s*\{{\s*$"
#: A piece that ends the name of a file whose start was cut off.
_CUT_NAME = r'(?s)^(?:[^"\\]++|\\.)*+"\s*:\s*\{\s*$'
_EMPTY = r"(?s)^\s*\{.*\}\s*$"


def _string_value(literal: Column) -> Column:
    """The value of a JSON string literal (null for an empty column)."""
    return F.when(literal != "", F.get(F.from_json(F.concat(F.lit("["), literal, F.lit("]")), T.ArrayType(T.StringType())), 0))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``(source, block_start, row_id, piece, key, opens)``: the pieces in the
    order of the file within a split. ``opens`` is (place of the piece, file
    name) where the piece ends with the start of a file; its name is null if the
    name itself was cut, as that of a file called ``Page_7`` is."""
    rows = read_lines(spark, path, line_sep=CUT)
    opens = _string_value(F.regexp_extract("line", _OPENS, 1))
    key = F.col("line").rlike(_KEY)
    return rows.select(
        F.col("file").alias("source"), "block_start", "row_id", F.col("line").alias("piece"), key.alias("key"),
        F.when(opens.isNotNull() | (~key & F.col("line").rlike(_CUT_NAME)),
               F.struct("block_start", "row_id", opens.alias("name"))).alias("opens"))


def _splits(pieces: DataFrame) -> DataFrame:
    """One row a split: the keys and the last file opened in the splits before
    it, whether a key (or nothing) follows it, and whether it cuts a name."""
    at = F.struct("block_start", "row_id")
    one = pieces.groupBy("source", "block_start").agg(
        F.sum(F.col("key").cast("bigint")).alias("keys"), F.max_by("opens", F.when(F.col("opens").isNotNull(), at)).alias("last"),
        F.min_by("key", at).alias("first_key"), F.max(F.col("opens").isNotNull() & F.col("opens.name").isNull()).alias("cuts_name"))
    w = Window.partitionBy("source").orderBy("block_start")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return one.select("source", "block_start", F.coalesce(F.sum("keys").over(before), F.lit(0)).alias("keys_before"),
                      F.last("last", ignorenulls=True).over(before).alias("opened_before"),
                      F.coalesce(F.lead("first_key").over(w), F.lit(True)).alias("key_next"), "cuts_name")


def _glued(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda x: x["piece"]), CUT)


def read_page_dict_object(spark: SparkSession, path: str) -> DataFrame:
    """``(file, page_key, page_no, page_text, line_format, text_from_images,
    text_from_tables, page_content, text)`` of one JSON object (or several
    files of one object each), read split-parallel.

    ``line_format`` holds each entry's JSON text. Files without pages give no
    rows. Text that is no such object fails the read. The object is UTF-8, with
    or without ``\\u`` escapes and with any blanks between its tokens."""
    w = Window.partitionBy("source", "block_start").orderBy("row_id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    splits = materialise(_splits(_pieces(spark, path)), "splits")
    cuts_name = splits.where("cuts_name").limit(1).count() > 0
    p = _pieces(spark, path).join(bounded_broadcast(splits.drop("cuts_name")), ["source", "block_start"])
    p = p.select(
        "source", "block_start", "row_id", "piece", "key",
        (F.col("keys_before") + F.sum(F.col("key").cast("bigint")).over(w)).alias("page"),
        F.coalesce(F.last("opens", ignorenulls=True).over(before), F.col("opened_before")).alias("opened"),
        F.coalesce(F.lead("key").over(w), F.col("key_next")).alias("whole"))
    # a page in one piece stays where it is; only pages cut inside a text are
    # gathered, and the head of the object (its brace and first file name)
    single = p.where("key AND whole").select("source", "opened", "piece")
    gathered = (p.where("NOT (key AND whole)").groupBy("source", "page")
                .agg(F.sort_array(F.collect_list(F.struct("block_start", "row_id", "piece", "opened"))).alias("ps")))
    glued = gathered.where("page > 0").select("source", F.get("ps", F.lit(0))["opened"].alias("opened"), _glued(F.col("ps")).alias("piece"))
    head = gathered.where("page = 0").select(_glued(F.col("ps")).alias("head"))
    pages = single.unionByName(glued)
    if cuts_name:  # names that stand in several pieces, read from the gathered text
        last = F.element_at("ps", -1)
        names = materialise(gathered.select(
            F.col("source").alias("source_"), last["block_start"].alias("block_"), last["row_id"].alias("row_"),
            _string_value(F.regexp_extract(_glued(F.col("ps")), _OPENS, 1)).alias("name")).where("name IS NOT NULL"), "file-names")
        pages = pages.join(bounded_broadcast(names), (F.col("source") == F.col("source_")) & (F.col("opened.block_start") == F.col("block_"))
                           & (F.col("opened.row_id") == F.col("row_")), "left")
        file = F.coalesce(F.col("opened.name"), F.col("name"))
    else:
        file = F.col("opened.name")
    strings = T.ArrayType(T.StringType())

    def failing(what: str, value: Column) -> Column:
        return F.raise_error(F.concat(F.lit(f"{what}: "), F.left(value, F.lit(80))))

    record = F.regexp_extract("piece", _PAGE, 2)
    pages = pages.select(file.alias("file"), F.regexp_extract("piece", r"^(\d+)", 1).alias("n"), "piece", record.alias("record"))
    fields = F.from_json(F.when(F.col("record") != "", F.col("record")).otherwise(failing("not a page record", F.col("piece"))), strings)
    pages = pages.select("file", "n", fields.alias("r"))
    out = pages.select("file", F.concat(F.lit("Page_"), "n").alias("page_key"), F.col("n").cast("bigint").alias("page_no"),
                       *[F.from_json(F.get("r", F.lit(i)), strings).alias(f.name) for i, f in enumerate(PAGE_RECORD.fields)])
    no_head = head.where(~F.col("head").rlike(_OPENS) & ~F.col("head").rlike(_EMPTY))
    checked = no_head.select(*[failing("not a page dictionary", F.col("head")).cast(f.dataType).alias(f.name) for f in out.schema.fields])
    return out.unionByName(checked).withColumn("text", F.array_join("page_content", ""))


def write_page_dict_object(pages: DataFrame, path: str, file_col: str = "doc_id", name: str = "pages.json") -> None:
    """K5: the corpus as one JSON object in ``path/name``, files by their name,
    pages by number. ``pages`` has one row a page with the five arrays of a page
    record; an entry of ``line_format`` becomes the list of its fonts and sizes,
    or a word. One file is one stream, so one task writes it, from the sorted
    pieces of all tasks. A null file is named ``""``; an empty corpus is ``{}``."""
    spark = pages.sparkSession
    rows = pages.withColumn("file", F.coalesce(F.col(file_col).cast("string"), F.lit("")))
    first_file = rows.agg(F.min("file")).first()[0]
    firsts = rows.groupBy("file").agg(F.min("page_no").alias("page_no")).withColumn("first", F.lit(True))
    rows = rows.join(firsts, ["file", "page_no"], "left")
    formats = F.transform("line_format", lambda x: F.when(x["kind"] == "text", F.concat(F.lit("["), F.array_join(F.concat(
        F.transform(x["fonts"], _quoted), F.transform(x["sizes"], lambda s: s.cast("string"))), ","), F.lit("]"))).otherwise(_quoted(x["kind"])))
    record = F.concat_ws(",", *[F.concat(F.lit("["), F.array_join(formats, ","), F.lit("]")) if f.name == "line_format"
                                else F.to_json(f.name) for f in PAGE_RECORD.fields])
    opening = F.concat(F.when(F.col("file") == F.lit(first_file), "").otherwise("},"), _quoted(F.col("file")), F.lit(":{"))
    content = F.concat(F.when(F.col("first"), opening).otherwise(","), F.lit(CUT), F.col("page_no").cast("string"), F.lit('":['), record, F.lit("]"))
    body = rows.select(F.lit(1).alias("part"), "file", "page_no", content.alias("content"))
    ends = spark.createDataFrame([(0, "{"), (2, "}" if first_file is None else "}}")], "part int, content string")
    write_one_file(body.unionByName(ends, allowMissingColumns=True), path, name, ["part", "file", "page_no"])


def _quoted(text: Column) -> Column:
    """JSON string literal of ``text``."""
    array = F.to_json(F.array(text))
    return F.substr(array, F.lit(2), F.length(array) - 2)
