"""Pages with several tables against a step-by-step walk of their elements."""

import random

from pyspark.sql import functions as F

from sifter.operators import layout

SCHEMA = ("doc_id long, page_no long, elem_ix int, y1 double, kind string, text string, table array<array<string>>, "
          "chars array<struct<font:string,size:double>>, table_y0 double")


def walk(elements):
    """(kept element numbers, shown table of each kept rectangle) of one page."""
    order = sorted(elements, key=lambda e: (-e["y1"], e["elem_ix"]))
    tables = [e["table"] for e in order if e["kind"] == "rect" and e["table"] is not None]
    kept, shown, region, previous = [], {}, -1, None
    extents, covering = [], []  # lower edges of all rectangles so far, and of those whose region has a table
    for e in order:
        if e["kind"] not in layout.KINDS:
            continue
        inside = any(e["y1"] > low for low in extents)
        if e["kind"] == "rect":
            if not inside and previous != "rect":
                region += 1
                if region < len(tables):
                    kept.append(e["elem_ix"])
                    shown[e["elem_ix"]] = tables[region]
            if e["table_y0"] is not None:
                extents.append(e["table_y0"])
                if region < len(tables):
                    covering.append(e["table_y0"])
        elif e["kind"] == "figure" or not any(e["y1"] > low for low in covering):
            kept.append(e["elem_ix"])
        previous = e["kind"]
    return kept, shown


def pages(rng, n):
    for page in range(n):
        out = []
        for ix in range(rng.randint(1, 14)):
            kind = rng.choice(["text", "text", "rect", "rect", "figure", "curve"])
            y1 = float(rng.randint(0, 9) * 10)
            rect = kind == "rect"
            out.append({"doc_id": page % 3, "page_no": page, "elem_ix": ix, "y1": y1, "kind": kind,
                        "text": f"t{ix}\n" if kind in ("text", "figure") else None,
                        "table": [[f"c{ix}", None]] if rect and rng.random() < 0.6 else None,
                        "chars": [("f", 1.0)], "table_y0": y1 - rng.choice([5, 15, 25]) if rect and rng.random() < 0.6 else None})
        yield out


def test_regions_equal_the_walk(spark):
    made = list(pages(random.Random(11), 150))
    rows = [e for p in made for e in p]
    rng = random.Random(1)
    rng.shuffle(rows)
    el = spark.createDataFrame(rows, SCHEMA)
    marked = layout.mark_tables(layout.order_elements(el)).orderBy("page_no", "ord").collect()
    records = {r.page_no: r for r in layout.assemble_pages(el, multi_table=True).collect()}
    several = 0
    for page in made:
        n = page[0]["page_no"]
        kept, shown = walk(page)
        assert [r.elem_ix for r in marked if r.page_no == n and r.keep] == kept, n
        assert [r.elem_ix for r in marked if r.page_no == n and r.emits_table] == [i for i in kept if i in shown]
        text = {e["elem_ix"]: e["text"] for e in page}
        want = ["|" + "|".join(c or "None" for c in shown[i][0]) + "|" if i in shown else text[i] for i in kept]
        assert records[n].page_content == want
        assert records[n].text_from_tables == [w for i, w in zip(kept, want) if i in shown]
        several += len(shown) > 1
    assert several > 20


def test_pages_without_extents_or_tables(spark):
    made = list(pages(random.Random(12), 60))
    el = spark.createDataFrame([e for p in made for e in p], SCHEMA)
    # without lower edges no text is inside a table
    got = {r.page_no: r for r in layout.assemble_pages(el.drop("table_y0"), multi_table=True).collect()}
    for page in made:
        plain = [{**e, "table_y0": None} for e in page]
        kept, shown = walk(plain)
        assert len(got[page[0]["page_no"]].page_content) == len(kept)
        assert sum(e["kind"] == "text" for e in page) == sum(x == "text" for x in (f.kind for f in got[page[0]["page_no"]].line_format))
    # no detected table: both rules keep all text and show nothing
    bare = el.withColumn("table", F.lit(None).cast("array<array<string>>"))
    one = sorted(layout.assemble_pages(bare, multi_table=True).collect())
    assert one == sorted(layout.assemble_pages(bare).collect())
    assert layout.assemble_pages(el.limit(0), multi_table=True).collect() == []
