"""Stored vectors and answers: what is computed again, and what is not."""

import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sifter.operators import hooks, store


def noted(folder, broken_by=None):
    """A generator that notes its prompts and breaks at one while a file stands."""
    def make():
        import uuid

        def answer(prompts):
            if broken_by and os.path.exists(f"{folder}/broken") and broken_by in prompts:
                raise RuntimeError("broken on purpose")
            with open(f"{folder}/{uuid.uuid4().hex}.calls", "w") as f:
                f.write("".join(p + "\n" for p in prompts))
            return ["to " + p for p in prompts]
        return answer
    return make


def calls(folder):
    return Counter(line for n in os.listdir(folder) if n.endswith(".calls") for line in open(f"{folder}/{n}").read().split("\n")[:-1])


def test_broken_run_resumes(spark, tmp_path):
    os.mkdir(tmp_path / "log")
    (tmp_path / "log" / "broken").write_text("")
    log = str(tmp_path / "log")
    rows = [(i, f"prompt {i % 37}") for i in range(80)] + [(100, None), (101, "")]
    df = spark.createDataFrame(rows, "id long, prompt string")
    kept = store.ContentStore(spark, str(tmp_path / "store"), "string")
    with pytest.raises(Exception, match="broken on purpose"):
        store.generate_resumable(df, "prompt", noted(log, "prompt 5"), kept, group_rows=8)
    before = kept.rows().count()
    done = {r["text"] for r in kept.rows().collect()}
    assert "prompt 5" not in done
    os.remove(tmp_path / "log" / "broken")
    answered = calls(log)
    got, n = store.generate_resumable(df, "prompt", noted(log, "prompt 5"), kept, group_rows=8)
    assert n == 38 - before
    assert sorted(got.collect(), key=lambda r: r.id) == [(i, p, None if p is None else "to " + p) for i, p in rows]
    again = calls(log) - answered
    assert set(again) == {p for _, p in rows if p is not None} - done and set(again.values()) == {1}
    assert store.generate_resumable(df, "prompt", noted(log), kept)[1] == 0
    assert kept.rows().count() == 38


def test_only_new_texts_are_encoded(spark, tmp_path):
    kept = store.ContentStore(spark, str(tmp_path / "store"), "array<float>")
    assert kept.rows().count() == 0
    old = spark.createDataFrame([(i, f"text {i % 200}") for i in range(400)], "id long, t string")
    assert store.embed_stored(old, "t", hooks.letter_encoder, kept)[1] == 200
    kept.rows().limit(1).write.parquet(f"{kept.path}/batches/never-named")  # a run that broke before its commit
    new = old.unionByName(spark.createDataFrame([(900, "new A"), (901, "new A"), (902, "new B"), (903, None)], "id long, t string"))
    got, n = store.embed_stored(new, "t", hooks.letter_encoder, kept)
    assert n == 2 and got.count() == 404
    full = hooks.embed(new.where("t is not null"), "t", hooks.letter_encoder).collect()
    assert sorted((r.id, tuple(r.embedding)) for r in got.where("t is not null").collect()) == sorted((r.id, tuple(r.embedding)) for r in full)
    assert got.where(F.col("t").isNull()).first()["embedding"] is None


def test_digest_alone_is_no_match(spark, tmp_path):
    kept = store.ContentStore(spark, str(tmp_path / "store"), "string")
    other = spark.createDataFrame([("b",)], "text string").select(F.sha2(F.lit("a").cast("binary"), 256).alias("digest"), "text", F.lit("wrong").alias("value"))
    kept.commit(other)
    df = spark.createDataFrame([("a",)], "t string")
    assert kept.missing(df.withColumnRenamed("t", "text")).count() == 1
    assert kept.look_up(df, "t", "v").first()["v"] is None


def test_batches_of_like_length():
    rows = pd.DataFrame({"words": sorted([1, 1, 2, 3, 3, 5, 8, 8, 30, 40])})
    cut = list(store.like_length_batches(iter([rows.iloc[:4], rows.iloc[4:4], rows.iloc[4:]]), 16))
    assert pd.concat(cut)["words"].tolist() == rows["words"].tolist()
    assert all(len(b) == 1 or len(b) * b["words"].max() <= 16 for b in cut)
    assert list(store.like_length_batches(iter([]), 16)) == []


def test_missing_texts_are_written_once(spark, tmp_path, monkeypatch):
    """groups are files of the one table of missing texts, no second copy."""
    monkeypatch.setattr(store, "ensure_checkpoint_dir", lambda _: str(tmp_path / "ck"))
    kept = store.ContentStore(spark, str(tmp_path / "a store"), "array<float>")
    df = spark.createDataFrame([(i, f"text {i % 40}") for i in range(90)], "id long, t string").repartition(3)
    got, n = store.embed_stored(df, "t", hooks.letter_encoder, kept, group_rows=8)
    assert n == 40 and got.where("embedding is null").count() == 0 and got.count() == 90
    written = spark.read.option("recursiveFileLookup", True).schema("text string").parquet(str(tmp_path / "ck" / "sifter-tables"))
    assert written.count() == 40
    sizes = [spark.read.parquet(f"{kept.path}/batches/{b}").count() for b in kept.batches()]
    assert sum(sizes) == 40 and max(sizes) <= 8 and len(sizes) >= 5
