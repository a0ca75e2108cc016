"""SimHash near-dedup and line dedup against brute force on small fixtures."""

import random

import numpy as np
import xxhash

from sifter.llm import line_dedup, simhash_dedup

rng = random.Random(5)
WORDS = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(300)]


def prose(n, r=rng):
    return " ".join(r.choice(WORDS) for _ in range(n))


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def texts_for_dedup():
    base = prose(400)
    out = [None, "", " \n", "one", "Two words", base, base.upper(), base]
    for i in range(40):
        w = base.split()
        w[rng.randrange(len(w))] = "zz"
        out.append(" ".join(w))
    return out + [prose(rng.randint(3, 60)) for _ in range(40)] + ["é ü 日本"]


def test_components_equal_brute_force(spark):
    texts = texts_for_dedup()
    rows = [(i + 10, t, "x") for i, t in enumerate(texts)] + [(None, texts[5], "y"), (12, texts[2], "z"), (12, texts[2], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash_dedup.simhash_components(docs).collect()
    assert len(got) == len(rows)
    fps = {r.fp % 2 ** 64 for r in got}
    assert fps == {brute_fingerprint(t) for _, t, _ in rows}
    own = sorted(fps)
    group = {f: f for f in own}
    for a in own:
        for b in own:
            if (a ^ b).bit_count() <= 3 and group[a] != group[b]:
                old, new = group[b], group[a]
                group = {k: new if v == old else v for k, v in group.items()}
    low = {}
    for i, t, _ in rows:
        if i is not None:
            g = group[brute_fingerprint(t)]
            low[g] = min(low.get(g, i), i)
    assert all(r.component == low[group[r.fp % 2 ** 64]] for r in got)
    kept = simhash_dedup.simhash_dedup(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(low.values())
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp"}


def test_links_over_random_fingerprints(spark):
    r = np.random.default_rng(1)
    base = r.integers(0, 2 ** 63, 60, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(j) for j in r.choice(64, k, replace=False)) for b in base for k in (1, 2, 3, 4)]
    block = [int(b) ^ (0b111 << int(s)) for b, s in zip(base, r.integers(0, 61, 60))]
    fps = sorted({*map(int, base), *near, *block})
    for radius in (1, 2, 3):
        key = np.array(fps, np.uint64)
        if radius % 2:
            k, own = (np.concatenate(x) for x in zip(*[simhash_dedup._block_variants(key, b, radius // 2) for b in range(4)]))
        else:
            m = np.array([0] + [1 << j for j in range(64)], np.uint64)
            k, own = (key[:, None] ^ m).ravel(), np.repeat(key, 65)
        node, root = simhash_dedup._forest(*simhash_dedup._pairs_in_buckets(k, own, radius))
        got = dict(zip(node.tolist(), root.tolist()))
        group = {f: f for f in fps}
        for i, a in enumerate(fps):
            for b in fps[i + 1:]:
                if (a ^ b).bit_count() <= radius and group[a] != group[b]:
                    lo, hi = sorted((group[a], group[b]))
                    group = {x: lo if v == hi else v for x, v in group.items()}
        assert {f: got.get(f, f) for f in fps} == group


def test_line_dedup_removes_passages_and_keeps_the_first(spark):
    r = random.Random(9)
    passage = [prose(20, r) + "." for _ in range(4)]
    long_line = prose(70, r)
    short = "All rights reserved."
    rows = []
    for i in range(30):
        lines = [prose(12, r) for _ in range(5)]
        if i % 3 == 0:
            lines[2:2] = passage
        if i % 5 == 1:
            lines.insert(1, long_line)
        rows.append((i, "\n".join([*lines, short]), i))
    rows += [(100, None, 0), (101, "", 0), (102, rows[4][1], 1), (102, rows[4][1], 2), (None, "\n".join(passage), 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int")
    got = {r.at if r.doc_id in (102, None) else (r.doc_id, "d"): r.text for r in line_dedup.line_dedup(docs).collect()}
    assert len(line_dedup.line_dedup(docs).collect()) == len(rows)
    assert got[(100, "d")] is None and got[(101, "d")] == ""
    # null ids sort first: the passage stays there and goes everywhere else
    assert got[3] == "\n".join(passage)
    for i in range(30):
        lines = rows[i][1].split("\n")
        want = [x for x in lines if x not in passage and not (x == long_line and i != 1)]
        assert got[(i, "d")] == "\n".join(want), i
    assert got[1] == got[2] == ""  # a copy of document 4, repeated rows alike


def test_line_dedup_removes_every_copy_of_a_long_line(spark):
    r = random.Random(21)
    shared = prose(60, r)
    twice = [prose(55, r) for _ in range(150)]
    rows = [(i, "\n".join([prose(9, r), shared, prose(8, r), twice[i // 2], prose(7, r)])) for i in range(300)]
    got = {x.doc_id: x.text.split("\n") for x in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = [x for k, x in enumerate(t.split("\n")) if not (k == 1 and i > 0) and not (k == 3 and i % 2)]
        assert got[i] == want, i


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_dedup.simhash_components(docs).count() == 0
    assert line_dedup.line_dedup(docs).count() == 0


def test_columns_of_any_name_pass(spark):
    """Extra columns may have the names that the operators use inside."""
    from sifter.llm import decontaminate, line_dedup, simhash_dedup

    names = ["firsts", "stops", "__n", "__id", "__th", "__rn", "id", "th", "c0", "a.b", "__removed_runs"]
    shared = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"own line {i} of this text\n{shared}\nlast words {i * 7}", *[f"{n}{i}" for n in names]) for i in range(4)]
    rows += [rows[0], (None, None, *[None] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    cut = line_dedup.line_dedup(docs)
    assert cut.columns == ["doc_id", "text", *names[:-1], "__removed_lines", "__removed_runs"]
    got = cut.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.firsts, r["a.b"]) for r in got if r.doc_id is not None) == sorted(
        (True, r[0], f"firsts{r[0]}", f"a.b{r[0]}") for r in rows if r[0] is not None)
    assert {r.doc_id for r in got if shared not in (r.text or shared)} == {1, 2, 3}
    left = simhash_dedup.simhash_dedup(docs)
    assert left.columns == docs.columns
    assert {(r.doc_id, r["__n"], r["c0"]) for r in left.collect()} <= {(r[0], r[4], r[10]) for r in rows}
    # rows of one item id make one row, however small the blocks of items are
    items = spark.createDataFrame([(5, shared), (5, f"{shared} and more"), (6, "not in any of them at all today")], "item_id long, text string")
    whole = decontaminate.contaminated(docs, items).collect()
    assert sorted(whole) == sorted(decontaminate.contaminated(docs, items, block_bytes=1).collect()) and len(whole) == 5
