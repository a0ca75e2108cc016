"""The one-object page dictionary, read in parallel, against json.load."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from sifter.sources.page_dict import read_page_dict_object, write_page_dict_object


def rows_of(obj):
    out = []
    for file, pages in obj.items():
        for key, rec in pages.items():
            out.append((file, int(key[5:]), rec[0], [json.dumps(x) for x in rec[1]], rec[2], rec[3], rec[4], "".join(rec[4])))
    return sorted(out, key=lambda r: r[:2])


def got_rows(spark, path, split=None):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows = read_page_dict_object(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for r in rows:
        assert r.page_key == f"Page_{r.page_no}"
    fmt = lambda xs: [json.dumps(json.loads(x)) if x[:1] in '["' else json.dumps(x) for x in xs]
    return sorted(((r.file, r.page_no, r.page_text, fmt(r.line_format), r.text_from_images, r.text_from_tables, r.page_content, r.text)
                   for r in rows), key=lambda r: r[:2])


TRICKY = ['"Page_3": [', 'Page_1 of 2', '\\"Page_0": [[', "}}, {", '"', "\\", '\\\\"', 'x]}, "y": {', "é\n\t ", "", '"Page_5', "Page_7\": {", "]", "},", "[[", ":"]
NAMES = ["a.pdf", "Page_7", 'q"Page_1', 'b, "c": {', "x]}", "é/ü", "", "Page_", '\\', 'Page_3": [', "Page_0 \"Page_9"]


def made(rng, files, pages):
    obj = {}
    for name in files:
        obj[name] = {}
        for n in range(rng.choice([0, 1, pages])):
            parts = [rng.choice(TRICKY) * rng.randint(1, 3) for _ in range(rng.randint(0, 4))]
            obj[name][f"Page_{n}"] = [parts, [[rng.choice(TRICKY), 9.5], "image"][:rng.randint(0, 2)], [rng.choice(TRICKY)], [], parts + ["end"]]
    return obj


@pytest.mark.parametrize("seed", [1, 4])
def test_equals_a_json_parser(spark, seed):
    rng = random.Random(seed)
    names = NAMES + [f"f{i}" for i in range(20)]
    rng.shuffle(names)
    obj = made(rng, names, 9)
    folder = tempfile.mkdtemp(prefix="sifter-object-")
    path = os.path.join(folder, "d.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(obj, f, ensure_ascii=seed % 2 == 0, indent=None if seed == 1 else 1, separators=(",", ":") if seed == 1 else None)
    for split in (4096, 600):
        assert got_rows(spark, path, split) == rows_of(obj)


def test_small_and_wrong_objects(spark):
    folder = tempfile.mkdtemp(prefix="sifter-object-")

    def written(text):
        path = os.path.join(folder, f"{random.random()}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return path

    assert got_rows(spark, written("{}")) == [] and got_rows(spark, written('{"a": {}, "b": {}}\n')) == []
    one = {"a": {}, "Page_1": {"Page_0": [[], [], [], [], ["t"]]}, "z": {}}
    assert got_rows(spark, written(json.dumps(one))) == rows_of(one)
    for bad in ("[1, 2]", '{"a": {"Page_0": [[], [], [], [], ["t"]]', '{"a": {"Page_0": [[], [], ["t"', "plain text"):
        with pytest.raises(Exception, match="not a page"):
            read_page_dict_object(spark, written(bad)).collect()


def test_several_objects_and_a_large_text(spark):
    folder = tempfile.mkdtemp(prefix="sifter-object-")
    objs = [made(random.Random(9), ["m", "n"], 5), {"big": {"Page_0": [[], [], [], [], ['"Page_1" ' * 40_000]], "Page_1": [["x"], [], [], [], ["y"]]}}]
    for i, obj in enumerate(objs):
        with open(os.path.join(folder, f"{i}.json"), "w", encoding="utf-8") as f:
            json.dump(obj, f)
    assert got_rows(spark, folder, 8192) == sorted(rows_of(objs[0]) + rows_of(objs[1]), key=lambda r: r[:2])


def test_written_object_is_json(spark):
    folder = tempfile.mkdtemp(prefix="sifter-object-")
    text = "struct<kind:string,fonts:array<string>,sizes:array<double>>"
    rows = [(f, n, [t], [("text", ["F\""], [9.5]), ("image", [], [])], [t], [], [t, "!"]) for f in ("b", "a\"", None) for n, t in ((10, "ten\n"), (2, "two\\"))]
    df = spark.createDataFrame(rows, f"doc_id string, page_no long, page_text array<string>, line_format array<{text}>, "
                                     "text_from_images array<string>, text_from_tables array<string>, page_content array<string>").repartition(3)
    write_page_dict_object(df, folder + "/o")
    with open(folder + "/o/pages.json", encoding="utf-8") as f:
        obj = json.load(f)
    assert list(obj) == ["", "a\"", "b"] and list(obj["b"]) == ["Page_2", "Page_10"]
    assert obj["b"]["Page_10"] == [["ten\n"], [["F\"", 9.5], "image"], ["ten\n"], [], ["ten\n", "!"]]
    assert got_rows(spark, folder + "/o/pages.json", 64) == rows_of(obj)
    write_page_dict_object(df.limit(0), folder + "/e")
    with open(folder + "/e/pages.json", encoding="utf-8") as f:
        assert f.read() == "{}"


def test_many_tasks_read_one_object(spark, small_dir):
    from sifter.operators.layout import assemble_pages
    from sifter.sources import fixtures as fx

    folder = tempfile.mkdtemp(prefix="sifter-object-")
    write_page_dict_object(assemble_pages(fx.elements(fx.table(spark, small_dir, "documents"))), folder + "/o")
    size = os.path.getsize(folder + "/o/pages.json")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 20))
    try:
        from sifter.sources.page_dict import _pieces

        used = _pieces(spark, folder + "/o/pages.json").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(used) >= 15 and max(r["count"] for r in used) < sum(r["count"] for r in used) / 5


def test_no_task_sorts_the_whole_object(spark, tmp_path, monkeypatch):
    from sifter.sinks import documents

    monkeypatch.setattr(documents, "PIECE_BYTES", 100)
    rows = spark.range(5000).select(F.col("id").alias("n"), F.format_string("%d\u00e9;", "id").alias("content"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        documents.write_one_file(rows.repartition(7), str(tmp_path / "one"), "all.txt", ["n"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (tmp_path / "one" / "all.txt").read_text() == "".join(f"{i}\u00e9;" for i in range(5000))
    assert sorted(os.listdir(tmp_path / "one")) == ["_SUCCESS", "all.txt"]
