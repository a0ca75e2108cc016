"""What page assembly moves and sorts."""

from sifter.operators import layout

SCHEMA = ("doc_id bigint, page_no bigint, elem_ix int, y1 double, kind string, text string, table array<array<string>>, "
          "chars array<struct<font string, size double>>")


def test_distinct_formats_are_sorted_not_characters(spark):
    rows = [(1, 0, 0, 9.0, "text", "b a\n", None, [("f", 2.0), ("e", 2.0), ("f", 1.0)] * 40), (1, 0, 1, 8.0, "text", "c\n", None, None),
            (1, 0, 2, 7.0, "figure", "d\n", None, [("g", 1.0)]), (1, 0, 3, 6.0, None, "e\n", None, [("h", 1.0)])]
    for multi in (False, True):
        el = spark.createDataFrame(rows, SCHEMA)
        el = el if not multi else el.selectExpr("*", "CAST(NULL AS DOUBLE) AS table_y0")
        pages = layout.assemble_pages(el, multi_table=multi)
        node = pages._jdf.queryExecution().optimizedPlan()
        while "Window" in node.toString().split("\n")[0] or "Window" in node.toString().split("\n", 1)[1]:
            node = node.children().apply(0)
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        assert "_fonts" in names and "chars" not in names
        got = pages.collect()[0]
        assert [tuple(x) for x in got.line_format] == [("text", ["e", "f"], [1.0, 2.0]), ("text", None, None), ("image", [], [])]
