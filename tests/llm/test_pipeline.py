"""The stages, one on what the other leaves, on the small tables."""

import corpus_pipeline
import __spark_entry__ as entry
from sifter.llm import decontaminate, simhash_dedup


def test_stages(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small_dir)
        if name != "sentencepiece":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name == "simhash_dedup":
            assert docs.count() == simhash_dedup.simhash_components(before).select("component").distinct().count()
        if name == "decontaminate":
            bench = spark.read.parquet(f"{small_dir}/benchmark.parquet")
            assert before.count() - docs.count() == decontaminate.contaminated(before, bench).select("doc_id").distinct().count()
    assert sizes == sorted(sizes, reverse=True) and sizes[1] >= 0.95 * sizes[0] and sizes[-1] > 0.5 * sizes[0]
    assert docs.where("not round_trip").count() == 0


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
