"""File sources, slide decks and sinks (files made in a temporary folder)."""

import json
import os
import re
import tempfile
import zipfile

from pyspark.sql import functions as F

from sifter.plans import jobs
from sifter.sinks import write_corpus, write_page_dict, write_per_document, write_result_csv
from sifter.sources import files, slides

P = "http://schemas.openxmlformats.org/presentationml/2006/main"
A = "http://schemas.openxmlformats.org/drawingml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _slide(shapes):
    body = []
    for kind, paras in shapes:
        if kind == "sp":
            ps = "".join("<a:p>" + "".join(
                '<a:br/>' if run == "\v" else f"<a:r><a:t>{run}</a:t></a:r>" for run in para) + "</a:p>"
                for para in paras)
            body.append(f"<p:sp><p:txBody>{ps}</p:txBody></p:sp>")
        elif kind == "pic":
            body.append("<p:pic/>")
        elif kind == "grp":
            body.append("<p:grpSp><p:sp><p:txBody><a:p><a:r><a:t>inner</a:t></a:r></a:p></p:txBody></p:sp></p:grpSp>")
    return (f'<p:sld xmlns:p="{P}" xmlns:a="{A}"><p:cSld><p:spTree><p:nvGrpSpPr/><p:grpSpPr/>'
            + "".join(body) + "</p:spTree></p:cSld></p:sld>")


def make_deck(path, slides_spec):
    """Slides listed in presentation order, stored under reversed part names."""
    n = len(slides_spec)
    with zipfile.ZipFile(path, "w") as z:
        ids = "".join(f'<p:sldId id="{256 + i}" r:id="rId{i + 1}"/>' for i in range(n))
        z.writestr("ppt/presentation.xml", f'<p:presentation xmlns:p="{P}" xmlns:r="{R}"><p:sldIdLst>{ids}</p:sldIdLst></p:presentation>')
        rels = "".join(f'<Relationship Id="rId{i + 1}" Target="slides/slide{n - i}.xml"/>' for i in range(n))
        z.writestr("ppt/_rels/presentation.xml.rels",
                   f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        for i, spec in enumerate(slides_spec):
            z.writestr(f"ppt/slides/slide{n - i}.xml", _slide(spec))


def deck_folder():
    root = tempfile.mkdtemp(prefix="sifter-decks-")
    sub = os.path.join(root, "sub")
    os.makedirs(sub)
    spec = [[("sp", [["Tit", "le"], ["ä line", "\v", "two"]]), ("pic", None), ("grp", None), ("sp", [["b\tc"]])],
            [("sp", [["second"]])]]
    for name in ["a_1.pptx", "a_-$.pptx", "(x).pptx", "plain.pptx"]:
        make_deck(os.path.join(sub, name), spec)
    make_deck(os.path.join(root, "top_level.pptx"), spec)
    with open(os.path.join(sub, "~$bad.pptx"), "wb") as f:
        f.write(b"not a zip")
    return root


def test_scan_and_extract_slides(spark):
    root = deck_folder()
    names = lambda df: sorted(r[0].rsplit("/", 1)[-1] for r in df.select("path").collect())
    assert names(files.scan_slides(spark, root)) == ["(x).pptx", "a_-$.pptx", "a_1.pptx", "plain.pptx", "~$bad.pptx"]
    assert names(files.scan_slides(spark, root, require_special=True)) == ["(x).pptx", "a_-$.pptx", "a_1.pptx", "~$bad.pptx"]
    shapes = slides.extract_slides(files.scan_slides(spark, root))
    rows = shapes.filter(F.col("file").endswith("/a_1.pptx")).orderBy("slide_no", "shape_ix").collect()
    assert [(r.slide_no, r.shape_ix, r.text) for r in rows] == [
        (0, 0, "Title\nä line\vtwo"), (0, 3, "b\tc"), (1, 0, "second")]
    bad = shapes.filter(F.col("file").endswith("~$bad.pptx")).collect()
    assert len(bad) == 1 and bad[0].error and bad[0].text is None
    assert slides.drop_unreadable(shapes).count() == 12
    nested, raw, clean = jobs.slide_corpus(shapes, lang="en")
    n = nested.filter(F.col("file").endswith("/a_1.pptx")).collect()[0]
    assert n.parts == ["Titleae linevtwo".replace("v", "\v"), "bc", "second"]
    assert clean.count() == 12
    # K5 for slides: {file: [parts]} per line
    out = tempfile.mkdtemp(prefix="sifter-slidedict-")
    write_page_dict(nested, os.path.join(out, "d"), file_col="file", value_col="parts")
    objs = [json.loads(r.value) for r in spark.read.text(os.path.join(out, "d")).collect()]
    merged = {k: v for o in objs for k, v in o.items()}
    assert merged[n.file] == n.parts and len(merged) == 4


def test_read_lines_and_passages(spark):
    d = tempfile.mkdtemp(prefix="sifter-lines-")
    with open(os.path.join(d, "c.txt"), "w", encoding="utf-8") as f:
        f.write("l0\n\nl2 é\nl3\n")
    lines = files.number_lines(files.read_lines(spark, d))
    assert [(r.line_no, r.line) for r in lines.orderBy("line_no").collect()] == [(0, "l0"), (1, ""), (2, "l2 é"), (3, "l3")]
    psg = files.read_passages(spark, d).orderBy("passage_no").collect()
    assert [r.passage for r in psg] == "l0\n\nl2 é\nl3\n".split("\n")


def test_read_passages_edge_files(spark):
    import bz2
    import gzip
    import re

    d = tempfile.mkdtemp(prefix="sifter-psg-")
    texts = {"a.txt": "x\r\ny\n\n", "b.txt": "no newline at end", "c.txt": "", "d.txt": "\n", "e.txt": "a\rb\r",
             "f.txt": "a\r\nb\r\n", "g.txt.gz": "a\nb\n", "h.txt.gz": "a\nb", "i.txt.bz2": "a\r\nb\r\n",
             "j.txt": "\ufeffa\nb\n", "k.txt": "\ufeffa\nb"}
    for name, t in texts.items():
        opener = {"gz": gzip.open, "bz2": bz2.open}.get(name.rsplit(".", 1)[-1], open)
        with opener(os.path.join(d, name), "wb") as f:
            f.write(t.encode("utf-8"))
    got = files.read_passages(spark, d).collect()
    for name, t in texts.items():
        rows = sorted((r.passage_no, r.passage) for r in got if r.file.endswith("/" + name))
        # Spark's file listing skips zero-length files, so an empty file
        # gives no passage instead of one empty one
        want = re.split("\r\n|\r|\n", t.removeprefix("\ufeff"))
        assert rows == (list(enumerate(want)) if t else []), name


def test_sinks_and_page_dict_roundtrip(spark, small_dir):
    from sifter.operators.layout import assemble_pages, nest_pages, with_page_text
    from sifter.sources import fixtures as fx

    docs = fx.table(spark, small_dir, "documents").filter(F.col("doc_id") < 5)
    pages = assemble_pages(fx.elements(docs))
    out = tempfile.mkdtemp(prefix="sifter-sink-")
    write_page_dict(nest_pages(pages), os.path.join(out, "dict"))
    back = files.read_page_dict(spark, os.path.join(out, "dict"))
    want = with_page_text(pages).select(F.col("doc_id").cast("string").alias("file"), "page_no", "text")
    assert sorted(back.select("file", "page_no", "text").collect()) == sorted(want.collect())
    # each JSON line parses to {file: {"Page_n": record}}
    line = open([os.path.join(out, "dict", f) for f in os.listdir(os.path.join(out, "dict")) if f.startswith("part")][0]).readline()
    obj = json.loads(line)
    assert list(obj.values())[0].keys() and all(k.startswith("Page_") for k in list(obj.values())[0])
    # positional layout of the original pipeline
    pos = os.path.join(out, "positional.json")
    with open(pos, "w", encoding="utf-8") as f:
        json.dump({"f.pdf": {"Page_0": [["t"], [["F", 1.0]], [], [], ["a\n", "b"]], "Page_1": [[], [], [], [], []]}}, f)
    prow = {r.page_no: r for r in files.read_page_dict_positional(spark, pos).collect()}
    assert {n: r.text for n, r in prow.items()} == {0: "a\nb", 1: ""}
    assert (prow[0].page_text, [json.loads(x) for x in prow[0].line_format], prow[1].text_from_tables) == (["t"], [["F", 1.0]], [])
    # K1 / K2 / K6
    texts = with_page_text(pages)
    write_per_document(texts, os.path.join(out, "docs"))
    folders = {d for d in os.listdir(os.path.join(out, "docs")) if d.startswith("doc_id=")}
    assert folders == {f"doc_id={i}" for i in range(5)}
    one = spark.read.text(os.path.join(out, "docs", "doc_id=0")).collect()
    assert [r.value for r in one] == "\n".join(
        r.text for r in texts.filter("doc_id = 0").orderBy("page_no").collect()).split("\n")
    write_corpus(texts.select("doc_id", "page_no", F.col("text").alias("line")), os.path.join(out, "corpus"), ["doc_id", "page_no"])
    got = spark.read.text(os.path.join(out, "corpus")).count()
    assert got >= texts.count()
    res = spark.createDataFrame([("p", 0.5)], "corpus_passage string, score double")
    write_result_csv(res, os.path.join(out, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(out, "csv")).columns == ["corpus_passage", "score"]


def test_number_lines_across_splits(spark):
    d = tempfile.mkdtemp(prefix="sifter-split-")
    lines = [f"line {i} " + "x" * (i % 37) for i in range(3000)]
    with open(os.path.join(d, "big.txt"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    with open(os.path.join(d, "small.txt"), "w", encoding="utf-8") as f:
        f.write("a\nb\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = files.read_lines(spark, d)
        assert raw.rdd.getNumPartitions() > 5
        got = files.number_lines(raw).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    big = sorted((r.line_no, r.line) for r in got if r.file.endswith("big.txt"))
    assert big == list(enumerate(lines))
    assert sorted((r.line_no, r.line) for r in got if r.file.endswith("small.txt")) == [(0, "a"), (1, "b")]


def test_scan_documents_recursive(spark):
    root = deck_folder()
    with open(os.path.join(root, "sub", "notes.txt"), "w", encoding="utf-8") as f:
        f.write("text file")
    names = lambda df: sorted(r.path.rsplit("/", 1)[-1] for r in df.select("path").collect())
    assert names(files.scan_documents(spark, root)) == sorted(
        ["(x).pptx", "a_-$.pptx", "a_1.pptx", "plain.pptx", "~$bad.pptx", "top_level.pptx", "notes.txt"])
    assert names(files.scan_documents(spark, root, "*.txt")) == ["notes.txt"]
    row = files.scan_documents(spark, root, "*.txt").collect()[0]
    assert row.length == 9 and bytes(row.content) == b"text file"


def test_folders_of_many_documents(spark, tmp_path, monkeypatch):
    """folders are named as Spark names them, a document of several parts is
    one text, files are listed once and read whole in few tasks."""
    monkeypatch.setattr(files, "PARTITIONS_OF_A_TASK", 64)
    keys = ["a", "a-b", "a b", "x/y", "50%", "k=v", "q\"'#*:?\\{[]^", "é", "__x", "", None]
    odd = spark.createDataFrame([(k, n, t) for k in keys for n, t in ((1, "two"), (0, "one"), (None, None))], "name string, page_no int, text string")
    write_per_document(odd, f"{tmp_path}/ours", "name")
    odd.select("name", F.col("text").alias("value")).write.partitionBy("name").text(f"{tmp_path}/theirs")
    folders = lambda p: {d for d in os.listdir(p) if "=" in d}
    assert folders(f"{tmp_path}/ours") == folders(f"{tmp_path}/theirs")
    for d in folders(f"{tmp_path}/ours") - {"name=__HIVE_DEFAULT_PARTITION__"}:
        assert "".join(open(f"{tmp_path}/ours/{d}/{f}").read() for f in os.listdir(f"{tmp_path}/ours/{d}")) == "\none\ntwo\n"
    # 7 large documents over more range partitions, and many short ones
    texts = {i: [f"{i} {n}" + "\n" * (n % 3) + ("\r" if n % 5 == 0 else "") for n in range(400 if i < 7 else 2)] for i in range(150)}
    rows = spark.createDataFrame([(i, n, t) for i, ts in texts.items() for n, t in enumerate(ts)], "doc_id long, page_no long, text string")
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda self, *cols, plain=type(rows).repartitionByRange: plain(self, 12, *cols))
    listed, plain = [], files.scan_documents
    monkeypatch.setattr(files, "scan_documents", lambda *a, **n: listed.append(a) or plain(*a, **n))
    write_per_document(rows, f"{tmp_path}/docs")
    assert max(len(os.listdir(f"{tmp_path}/docs/doc_id={i}")) for i in range(7)) > 1
    want = {(i, n, line) for i, ts in texts.items() for n, line in enumerate(re.split("\r\n|\r|\n", "".join(t + "\n" for t in ts)))}
    for named in (files.MAX_NAMED_FILES, 2):
        monkeypatch.setattr(files, "MAX_NAMED_FILES", named)
        listed.clear()
        got = files.read_folder_passages(spark, f"{tmp_path}/docs")
        found = [(int(re.search(r"doc_id=(\d+)/", r.file)[1]), r.passage_no, r.passage) for r in got.collect()]
        assert len(listed) == 1 and len(found) == len(set(found)) and set(found) == want
    assert files.read_passages(spark, f"{tmp_path}/docs").rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism


def test_long_files_are_split_and_short_ones_cut_whole(spark, tmp_path, monkeypatch):
    import gzip

    texts = {"a.txt": b"x\r\ny\n\n" * 50, "b.txt": b"\xef\xbb\xbfone\rtwo\n" * 40, "c.txt": b"bad \xff\xfe bytes\n\nend", "d.txt": b"\xef\xbb\xbfz", "e.txt.gz": b"p\nq\n" * 9}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(gzip.compress(t) if name.endswith("gz") else t)
    rows = lambda: sorted((r.file.rsplit("/", 1)[1], r.passage_no, bytes(r.b)) for r in files.read_passages(spark, str(tmp_path)).withColumn("b", F.col("passage").cast("binary")).collect())
    monkeypatch.setattr(files, "WHOLE_FILE_BYTES", 0)
    split = rows()
    monkeypatch.setattr(files, "WHOLE_FILE_BYTES", 100)
    assert rows() == split
    monkeypatch.setattr(files, "WHOLE_FILE_BYTES", 8 << 20)
    monkeypatch.setattr(files, "CUT_BYTES", 10)
    assert rows() == split and ("a.txt", 150, b"") in split
