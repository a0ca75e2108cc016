"""Named-file sink (K1) and the deck source."""

import os
import subprocess
import sys
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from sifter.sinks.documents import document_key, file_name, write_document_files, write_files
from sifter.sources import files, slides
from sifter.sources.decks import OPEN_COST, pack, read_decks
from sifter.sources.fixtures import deck_bytes

from .test_sources_sinks import deck_folder

KEYS = ["a/b/c.pdf", "a%2Fb", "_hidden", ".dot", "plain", "ä b", "x\\y", "a:b", "%", "", "_.", "n\nl", "100%25"]


def contents(folder):
    out = {}
    for name in os.listdir(folder):
        assert os.path.isfile(os.path.join(folder, name)), "no folder per document"
        with open(os.path.join(folder, name), "rb") as f:
            out[name] = f.read().decode()
    assert out.pop("_SUCCESS") == ""
    return out


def test_names_can_be_taken_back(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string").select("k", file_name(F.col("k")).alias("n"))
    rows = df.select("k", "n", document_key(F.col("n")).alias("back")).collect()
    assert all(r.back == r.k for r in rows) and len({r.n for r in rows}) == len(KEYS)
    assert not any(set(r.n) & set("/\\\0\n:") or r.n[0] in "._" for r in rows)
    assert spark.range(1).select(file_name(F.lit(None).cast("string"))).first()[0] == "%2Etxt"


def test_one_file_per_document(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="sifter-k1-"), "docs")
    pages = [(k, p, None if p == 3 else f"{k} page {p}") for k in KEYS if k for p in range(12)]
    df = spark.createDataFrame(pages, "doc_id string, page_no long, text string").repartition(5)
    write_document_files(df, out)
    got = contents(out)
    want = {}
    for k, p, t in sorted(pages, key=lambda r: (r[0], r[1])):
        want[k] = want.get(k, "") + (t or "") + "\n"
    names = {r.n: r.doc_id for r in df.select("doc_id", file_name(F.col("doc_id")).alias("n")).distinct().collect()}
    assert {names[n]: t for n, t in got.items()} == want
    # a second run replaces the folder, append adds to it, a failing one leaves it
    write_document_files(df.where("doc_id = 'plain'"), out)
    assert list(contents(out)) == ["plain.txt"]
    write_document_files(df.where("doc_id = '.dot'"), out, mode="append")
    assert sorted(contents(out)) == ["%2Edot.txt", "plain.txt"]
    with pytest.raises(Exception):
        write_document_files(df.withColumn("text", F.when(F.col("page_no") == 11, F.raise_error(F.lit("no"))).otherwise(F.col("text"))), out)
    assert sorted(contents(out)) == ["%2Edot.txt", "plain.txt"]
    assert os.listdir(os.path.dirname(out)) == ["docs"]  # no staging folder stays
    write_document_files(df.limit(0), out)
    assert contents(out) == {}


RETRY = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from sifter.sinks.documents import write_files
spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.adaptive.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[2] + "-ckpt").getOrCreate())
df = spark.range(4000).selectExpr("concat('d', id % 40) AS name", "id AS k", "concat('line ', id, '\\n') AS content")

from sifter.sinks import documents
write = documents._FilesWriter.write
def failing(self, iterator):
    def rows():
        from pyspark import TaskContext
        for i, b in enumerate(iterator):
            yield b
        if TaskContext.get().attemptNumber() < 2:
            raise RuntimeError("lost")
    return write(self, rows())
documents._FilesWriter.write = failing
write_files(df, sys.argv[2], order=["k"])
spark.stop()
"""


def test_a_lost_task_is_written_again():
    out = os.path.join(tempfile.mkdtemp(prefix="sifter-retry-"), "docs")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRY, root, out], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "RuntimeError: lost" in done.stderr  # attempts did fail
    assert contents(out) == {f"d{d}": "".join(f"line {i}\n" for i in range(d, 4000, 40)) for d in range(40)}
    assert sorted(os.listdir(os.path.dirname(out)))[0] == "docs"


def test_unsorted_rows_are_refused(spark):
    from sifter.sinks.documents import NamedFiles

    spark.dataSource.register(NamedFiles)
    out = os.path.join(tempfile.mkdtemp(prefix="sifter-order-"), "docs")
    df = spark.createDataFrame([("b", b"1"), ("a", b"2"), ("b", b"3")], "name string, content binary").coalesce(1)
    with pytest.raises(Exception, match="sorted by file name"):
        df.write.format("sifter_files").mode("append").option("path", out).save()
    assert not os.path.exists(out)


def test_packing_by_bytes():
    files_ = [(f"f{i}", f"/f{i}", s) for i, s in enumerate([0, 10 << 20, 500 << 20, 1, 1, 1])]
    groups = pack(files_, 32 << 20)
    assert [[n for n, _ in g] for g in groups] == [["f0", "f1"], ["f2"], ["f3", "f4", "f5"]]
    assert [f for g in groups for f in g] == [(n, p) for n, p, _ in files_]
    assert len(pack(files_, OPEN_COST)) == 6 and pack([], 1) == []


def test_decks_read_in_place_equal_the_file_scan(spark):
    root = deck_folder()
    with open(os.path.join(root, "sub", "empty_1.pptx"), "wb"):
        pass
    # a deck whose second slide is damaged gives an error and none of its text
    raw = deck_bytes([["one"], ["two"]])
    with open(os.path.join(root, "sub", "half_1.pptx"), "wb") as f:
        f.write(raw)
    with zipfile.ZipFile(os.path.join(root, "sub", "half_1.pptx"), "a") as z:
        z.writestr("ppt/slides/slide2.xml", "<p:sld")
    for special in (False, True):
        want = slides.extract_slides(files.scan_slides(spark, root, require_special=special)).collect()
        for size in (1, 1 << 30):
            got = read_decks(spark, root, special, size)
            # Spark's file listing leaves out files without a byte; here they are unreadable decks
            assert got.rdd.getNumPartitions() == (1 if size > 1 else len({r.file for r in want}) + 1)
            rows = got.collect()
            key = lambda r: (r.file, r.slide_no or 0, r.shape_ix or 0)
            strip = lambda rs: [(*r[:4], bool(r.error)) for r in sorted(rs, key=key)]
            assert strip([r for r in rows if "empty_1" not in r.file]) == strip(want)
            assert {r.file.rsplit("/", 1)[-1] for r in rows if r.error} == {"~$bad.pptx", "empty_1.pptx", "half_1.pptx"}
    assert slides.drop_unreadable(read_decks(spark, root)).where("file like '%half%'").count() == 0
    assert read_decks(spark, os.path.join(root, "sub")).count() == 0  # only files below the folder
    assert deck_bytes([]) and slides.deck_shapes(deck_bytes([["a\nb", ""], []])) == [(0, 0, "a\nb"), (0, 1, "")]
