"""Trained operators: held-out accuracy, gradients, brute force on small data."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sifter.llm import _common, decontaminate, language_id, pseudo_likelihood, quality_classifier

SF = "/root/testdata/sf0.01"


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = language_id.op1_language_id(spark, SF).join(docs, "doc_id").where("held_out and n > 200").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


def test_language_id_tables_equal_convolution():
    net = language_id.ByteCNN(["a", "b", "c"])
    x = np.random.default_rng(0).integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    e = net.emb[x]
    h = [np.concatenate([e[:, i:x.shape[1] - w + 1 + i] for i in range(w)], 2) @ k for w, k in zip(language_id.WIDTHS, net.conv)]
    r = np.maximum(np.concatenate([z.max(1) for z in h], 1) + net.bias, 0)
    p = np.exp(r @ net.out + net.out_bias)
    assert np.allclose(net.window_probs(x), p / p.sum(1, keepdims=True), atol=1e-5)


def test_language_id_edges(spark):
    model = language_id.ByteCNN(["de", "en"])
    docs = spark.createDataFrame([(1, None, "x"), (2, "12 !?", "x"), (3, "a", None), (3, "a", None), (4, "b" * 70000, "")],
                                 "doc_id long, text string, score string")
    got = language_id.identify(docs, model)
    rows = got.collect()
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    assert [r.lang_pred == "und" for r in rows] == [True, True, False, False, False]
    assert all(0 <= r.score <= 1 for r in rows)
    assert language_id.identify(docs, language_id.ByteCNN([])).where("lang_pred <> 'und'").count() == 0


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_classifier.op5_quality_classifier(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_trees_flat_traversal_and_edges(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    m = quality_classifier.BoostedTrees.fit(x, y, trees=40)
    assert ((m.score(x) > 0.5) == y).mean() > 0.97
    slow = []
    for row in x[:50]:
        total = m.prior
        for f, t, leaf in zip(m.feature, m.threshold, m.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += leaf[node - len(f)]
        slow.append(total)
    assert np.allclose(m.margin(x[:50]), slow)
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, " \n")], "doc_id long, text string")
    none = quality_classifier.train_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality_classifier.score_quality(docs, none).collect()} == {0.5}


def test_pseudo_likelihood_probabilities_and_context(spark):
    net = pseudo_likelihood.WindowNet(50, classes=7).set_counts(np.arange(50.0))
    ctx = np.random.default_rng(4).integers(0, 50, (4, 3))
    total = sum(np.exp(net.log_probs(ctx, np.full(3, t))) for t in range(net.classes * net.width))
    assert np.allclose(total, 1, atol=1e-4)
    ids, lengths = np.array([5, 6, 7, 8, 9]), np.array([2, 0, 3])
    want = [[99, 99, 99, 99, 7], [99, 5, 99, 7, 8], [6, 99, 8, 9, 99], [99, 99, 9, 99, 99]]
    assert pseudo_likelihood.contexts(ids, lengths, 99).tolist() == want


def _plain_log_probs(net, context, target):
    out = []
    for n, t in enumerate(target):
        h = np.tanh(sum((net.emb[i, context[i, n]] for i in range(2 * pseudo_likelihood.SIDE)), net.bias).astype(float))
        c, j = divmod(int(t), net.width)
        a, b = h @ net.top + net.top_bias, h @ net.low[c] + net.low_bias[c]
        out.append(a[c] - a.max() - np.log(np.exp(a - a.max()).sum()) + b[j] - b.max() - np.log(np.exp(b - b.max()).sum()))
    return np.array(out)


def test_pseudo_likelihood_gradients_and_far_logits(monkeypatch):
    r = np.random.default_rng(5)
    for scale, run in ((1, 1024), (1, 3), (400, 4)):  # 400: a row's greatest logit may be far below what it could be
        monkeypatch.setattr(pseudo_likelihood, "RUN", run)
        net = pseudo_likelihood.WindowNet(30, classes=5, embed=6).set_counts(r.integers(0, 9, 30).astype(float))
        for p in net.params():
            p += (0.3 * r.normal(size=p.shape)).astype(np.float32)
        net.low *= np.float32(scale)
        net.top *= np.float32(scale)
        context, target = r.integers(0, 30, (2 * pseudo_likelihood.SIDE, 41)), r.integers(0, 30, 41)
        assert np.allclose(net.log_probs(context, target), _plain_log_probs(net, context, target), rtol=1e-4, atol=1e-3)
        if scale > 1:
            continue
        grads, dz, at = net.gradients(context, target)
        by_row = np.zeros_like(net.emb)
        for i in range(2 * pseudo_likelihood.SIDE):
            np.add.at(by_row[i], at[i], dz)
        for p, g in zip(net.params(), [by_row, *grads]):
            for k in r.choice(p.size, min(p.size, 12), replace=False):
                flat, kept = p.reshape(-1), p.reshape(-1)[k]
                flat[k] = kept + 1e-3
                up = _plain_log_probs(net, context, target).sum()
                flat[k] = kept - 1e-3
                down = _plain_log_probs(net, context, target).sum()
                flat[k] = kept
                assert abs((down - up) / 2e-3 - g.reshape(-1)[k]) < 0.02


def test_pseudo_likelihood_beats_shuffled_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.length("text") > 500)
    vocab, counts = pseudo_likelihood.vocabulary(docs)
    tokens = pseudo_likelihood.materialise(pseudo_likelihood.token_ids(docs, vocab), "t")
    net = pseudo_likelihood.train(tokens, counts, every=4)
    before = pseudo_likelihood.WindowNet(len(counts)).set_counts(counts)
    mean = lambda n: pseudo_likelihood.score(tokens, n).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    assert mean(net) > mean(before) + 0.1
    odd = spark.createDataFrame([(1, None), (None, ""), (2, "the the")], "doc_id long, text string")
    rows = pseudo_likelihood.score(pseudo_likelihood.token_ids(odd, vocab), net).collect()
    assert [r.n_tokens for r in rows] == [0, 0, 2] and rows[0].mean_log_prob is None and rows[2].log_prob < 0


def test_pseudo_likelihood_of_bucketed_words(spark):
    texts = [" ".join(f"w{(i * 7 + j * j) % 1500 if j % 3 else j % 5}" for j in range(60)) for i in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None)], "doc_id long, text string").repartition(3)
    counted = pseudo_likelihood.word_counts(docs)
    vocab, counts = pseudo_likelihood.vocabulary(docs, words=48, buckets=7, counted=counted)
    net = pseudo_likelihood.WindowNet(len(counts)).set_counts(counts)
    odd = docs.union(spark.createDataFrame([(900, "w0 neverseen w1")], "doc_id long, text string"))
    pieces = pseudo_likelihood.materialise(pseudo_likelihood.token_pieces(odd, vocab, piece=600), "t")
    got = {r.id: r for r in pseudo_likelihood.score_words(pieces, net, vocab, counted).collect()}
    by_id = {r.id: r.log_prob for r in pseudo_likelihood.score(pseudo_likelihood.token_ids(odd, vocab), net).collect()}
    n = {bytes(r.word): r.n for r in counted.collect()}
    bucket = lambda w: zlib.crc32(w) % 7
    rare = [w for w in n if w not in vocab]

    def share(w):
        own = [n[v] for v in rare if bucket(v) == bucket(w)]
        return (n.get(w, 0) + 0.5) / (sum(own) + 0.5 * (len(own) + 1))

    assert pieces.select("piece").distinct().count() > 3 and len(got) == len(by_id) == 102
    for i, t in [*enumerate(texts), (900, "w0 neverseen w1")]:
        more = sum(np.log(share(w)) for w in t.encode().split() if w not in vocab)
        assert np.isclose(got[i].log_prob, by_id[i] + more), i
    assert got[None].n_tokens == 0 and got[None].mean_log_prob is None
    once, top = min(rare, key=n.get), max(vocab, key=n.get)
    docs = spark.createDataFrame([(0, "madeupword"), (1, once.decode()), (2, top.decode())], "doc_id long, text string")
    pieces = pseudo_likelihood.materialise(pseudo_likelihood.token_pieces(docs, vocab), "t")
    alone = {r.id: r.log_prob for r in pseudo_likelihood.score_words(pieces, net, vocab, counted).collect()}
    assert alone[0] < alone[1] < alone[2]


def test_words_numbered_by_arrow(spark):
    texts = [None, "", " \n", "B a\tb\x0bB", "  É é\x1cE\x85x\u00a0y  a\r\n", "a" * 300, None, "\x00 b", "x"]
    own = [(t or "").encode().lower().split() for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["skipped", *texts], kind).slice(1)
        words, at, ends = _common.numbered_words(column)
        assert words.to_pylist() == list(dict.fromkeys(w for ws in own for w in ws))
        flat = [words[i].as_py() for i in at.tolist()]
        assert [flat[a:z] for a, z in zip([0, *ends.tolist()], ends.tolist())] == own
        runs = list(_common.text_chunks(column, 12))
        assert [i for first, n in runs for i in range(first, first + n)] == list(range(len(texts)))
        assert all(n == 1 or sum(len((t or "").encode()) for t in texts[first:first + n]) <= 12 for first, n in runs)
    assert [len(x) for x in _common.numbered_words(pa.array([], pa.string()))] == [0, 0, 0]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").repartition(2)
    want = Counter(w for ws in own * 3 for w in ws)
    for most in (1, 40, 1 << 20):
        assert {bytes(r.word): r.n for r in pseudo_likelihood.word_counts(docs, most=most).collect()} == want
    assert pseudo_likelihood.word_counts(docs.limit(0)).count() == 0


def test_word_counts_of_many_distinct_words(spark):
    docs = spark.range(1).selectExpr("id doc_id", "concat_ws(' ', transform(sequence(0, 449999), x -> string(x % 225000))) text")
    counted = pseudo_likelihood.materialise(pseudo_likelihood.word_counts(docs.unionByName(docs).coalesce(1)), "w")
    assert counted.agg(F.count("*"), F.min("n"), F.max("n")).first()[:] == (225000, 4, 4)


def test_pseudo_likelihood_ids_grow_with_distinct_words(spark):
    sizes = [len(pseudo_likelihood.vocabulary(None, counted=spark.range(n).selectExpr("cast(string(id) as binary) word", "1L n"))[1]) for n in (10, 100_000, 1_000_000)]
    assert sizes == [1024, 2048, 4096]


def test_pseudo_likelihood_trains_on_every_position_once(spark):
    ids = np.random.default_rng(2).integers(0, 1024, 5000)
    for every in (pseudo_likelihood.TRAIN_EVERY, 4, 1):
        rounds = [pseudo_likelihood.picked(ids, turn, every) for turn in range(pseudo_likelihood.ROUNDS)]
        assert sorted(np.concatenate(rounds).tolist()) == list(range(5000))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    vocab, counts = pseudo_likelihood.vocabulary(docs)
    tokens = pseudo_likelihood.materialise(pseudo_likelihood.token_ids(docs, vocab), "t")
    mean = lambda n: pseudo_likelihood.score(tokens, n).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    assert mean(pseudo_likelihood.train(tokens, counts)) > mean(pseudo_likelihood.WindowNet(len(counts)).set_counts(counts)) + 0.1


def test_decontamination_equals_brute_force(spark):
    items = [r for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = [decontaminate.words_of(i.text) for i in items]
    edited = [w[:len(w) // 2] + ["zzz"] + w[len(w) // 2 + 1:] for w in words[:12]]
    texts = ["pre fix " + " ".join(w) + " and more" for w in words[:10]] + ["x " + " ".join(w) for w in edited]
    texts += [" ".join(words[3][: len(words[3]) // 2]), "", None, "short", " ".join(words[0] + words[1]), "né " * 5000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i.item_id, i.text) for i in items] + [(900, None), (901, ""), (902, "only three words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, block_bytes=3000).collect()}
    want = set()
    for d, t in enumerate(texts):
        own = decontaminate.words_of(t or "")
        for i, w in zip(items, words):
            b = decontaminate.Counter(decontaminate.word_shingles(w))
            n = sum(b.values())
            if any(decontaminate.similarity(decontaminate.word_shingles(own[s:s + len(w)]), b, n) >= 0.8 for s in range(len(own) - len(w) + 1)):
                want.add((d, i.item_id))
    assert got == want and len(want) >= 12
    kept = decontaminate.decontaminate(docs, bench).collect()
    assert {r.doc_id for r in kept} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(texts)


def test_decontamination_of_documents_shorter_than_the_item(spark):
    items = [(i, " ".join(f"i{i}w{j}" for j in range(n))) for i, n in enumerate((40, 41, 12, 9, 6, 5, 4, 2))] + [(50, "only " * 30)]
    texts = [" ".join(w[:len(w) - cut]) for _, t in items for w in [t.split()] for cut in range(12) if cut < len(w)]
    texts += [" ".join(w[:len(w) // 2] + w[len(w) // 2 + 1:]) for w in (t.split() for _, t in items)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=300).collect()}
    want = {}
    for d, t in enumerate(texts):
        own = decontaminate.words_of(t)
        for i, text in items:
            w = decontaminate.words_of(text)
            b = decontaminate.Counter(decontaminate.word_shingles(w))
            sims = [decontaminate.similarity(decontaminate.word_shingles(own[s:s + len(w)]), b, sum(b.values())) for s in range(max(1, len(own) - len(w) + 1))]
            if max(sims) >= 0.8:
                want[d, i] = max(sims)
    assert {k: r.similarity for k, r in got.items()} == want
    assert got[1, 0].n_words == 39 and got[1, 0].first_word == 0 and sum(len(decontaminate.words_of(texts[d])) < len(items[i][1].split()) for d, i in want if i < 50) > 10
