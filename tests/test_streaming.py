import os
import tempfile

from sifter.functions.text import RETRIEVAL_PROFILE
from sifter.streaming.ingest import start_clean_ingest


def test_stream_clean_ingest(spark):
    import re

    src = tempfile.mkdtemp(prefix="sifter-src-")
    out = tempfile.mkdtemp(prefix="sifter-out-")
    ck = tempfile.mkdtemp(prefix="sifter-ck-")
    lines = ["  a $b  ", "", "   ", "c -- d"]
    with open(os.path.join(src, "f.txt"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    q = start_clean_ingest(spark, src, out, ck)
    q.awaitTermination(120)
    got = sorted(r.line for r in spark.read.parquet(out).collect())

    def py(s):
        s = s.strip()
        for p, r in RETRIEVAL_PROFILE:
            s = re.sub(p, r, s)
        return s

    assert got == sorted(py(s) for s in lines if not (py(s) + "\n").isspace())
