import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from llm_corpus import corpus, frame, with_clashes
from stratum.llm import pu_quality as pq
from stratum.llm import textwin


def labelled(spark, n=900, seed=3):
    """Prose (70 %), and stuttered or sign-ridden text; half the rows have a label."""
    rng = random.Random(seed)
    docs, labels, truth = [], [], {}
    for i in range(n):
        y = int(rng.random() < 0.7)
        w = [f"{'abcdefgh'[rng.randrange(8)]}{rng.choice(['on', 'est', 'ing'])}{rng.choice(['', 'al'])}"
             for _ in range(rng.randrange(30, 150))]
        if not y and i % 2:
            w = [x for x in w for _ in range(4)]
        elif not y:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w)))
        truth[i] = y
        if rng.random() < 0.5:
            labels.append((i, y, 0))
    docs += [(None, None), (n, ""), (n + 1, None), (n + 2, "\n\n \t"), (n + 3, "x"),
             (n + 4, "word " * 60000), (5, "repeated id"), (5, "repeated id")]
    labels += [(None, 1, 1), (7, None, 1), (8, 9, 0), (10**6, 1, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth, len(docs))


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels, truth, n = labelled(spark)
    got = pq.score_documents(with_clashes(docs), labels).collect()
    assert len(got) == n
    right = total = 0
    for r in got:
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.held_out and r.doc_id in truth and r.doc_id != 5:
            total += 1
            right += r.predicted == truth[r.doc_id]
    assert total > 100 and right / total > 0.97
    again = {r.doc_id: r.score for r in pq.score_documents(docs.repartition(7), labels).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in got if r.doc_id not in (5, None))
    kept = pq.keep_good(with_clashes(docs), labels)
    assert kept.columns == with_clashes(docs).columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        r.doc_id or -1 for r in got if r.predicted)


def test_prior_and_labels_of_the_held_out_fifth(spark):
    docs, labels, truth, _ = labelled(spark)
    table = pq.feature_table(docs, "doc_id", "text")
    model = pq.fit(table, labels)
    assert abs(model.prior - 0.7) < 0.07
    # Neither negatives nor labels of the held-out fifth change anything.
    from pyspark.sql import functions as F
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.where(~held & (F.col("quality") == 1)).unionByName(
        labels.where(held).withColumn("quality", F.lit(1)))
    assert np.allclose(pq.fit(table, other).weights, model.weights, atol=1e-9)


def test_risk_and_gradients_equal_plain_sums(spark):
    docs, labels, _, _ = labelled(spark, 120)
    table = pq.feature_table(docs, "doc_id", "text")
    x = np.array([r._x for r in table.collect()], float)
    scale = pq.fit_scale(table)
    assert np.allclose(scale.mean, x.mean(axis=0)) and np.allclose(scale.width, x.std(axis=0) + 1e-3)
    u = scale(x)
    positives, prior = u[::3], 0.6
    sig = lambda z: 1 / (1 + np.exp(-z))

    def plain(w):
        p, q = sig(positives @ w), sig(u @ w)
        return (prior * (1 - p).mean() + max(0.0, q.mean() - prior * p.mean())
                + 0.5 * pq.RIDGE * (w[:-1] @ w[:-1]))

    rng = np.random.RandomState(1)
    clipped = set()
    for shift in (0.0, 3.0, -3.0):
        w = rng.randn(u.shape[1]) * 0.05
        w[-1] += shift
        got = pq.pu_risk(table, scale, positives, prior, w)
        assert np.isclose(got.value, plain(w))
        clipped.add(bool(sig(u @ w).mean() < prior * sig(positives @ w).mean()))
        for k in rng.choice(len(w), 8, replace=False):
            e = np.zeros(len(w))
            e[k] = 1e-5
            assert np.isclose(got.gradient[k], (plain(w + e) - plain(w - e)) / 2e-5, atol=1e-6)
        assert np.linalg.eigvalsh(got.curve).min() > 0
    assert clipped == {False} or clipped == {False, True}


def test_features_equal_plain_python():
    texts = [t or "" for _, t in corpus(9, 60)] + ["a\n\na\nb\n", "A! B! A!", "\n", " x"]
    data, offs = textwin.buffers(pa.array(texts))
    got = pq.text_features(data, offs)
    for row, text in zip(got, texts):
        raw = text.encode()
        kinds = [int(pq.CLASS[b]) for b in raw]
        pairs = Counter(zip(kinds, kinds[1:]))
        for (a, b), n in pairs.items():
            assert np.isclose(row[a * pq.CLASSES + b], (n / (len(raw) - 1)) ** 0.5)
        assert np.isclose((row[:64] ** 2).sum(), 1.0 if len(raw) > 1 else 0.0)
        w = [x for x in raw.replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if x]
        many = max(1, len(w))
        same = sum(p == q for p, q in zip(w, w[1:])) / many
        lines = [x for x in raw.split(b"\n") if x]
        assert np.isclose(row[64], np.log1p(len(w)))
        assert np.isclose(row[65], sum(map(len, w)) / many)
        assert np.isclose(row[67], same ** 0.5)
        assert np.isclose(row[70], len(set(w)) / many)
        assert np.isclose(row[71], (max(Counter(w).values(), default=0) / many) ** 0.5)
        assert np.isclose(row[75], ((len(lines) - len(set(lines))) / max(1, len(lines))) ** 0.5)


def test_no_positives_and_empty_tables(spark):
    docs = frame(spark, corpus(2, 40))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in pq.score_documents(docs, none).collect()} == {0.0}
    bad = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, quality int")
    assert {r.predicted for r in pq.score_documents(docs, bad).collect()} == {0}
    good = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    assert pq.score_documents(docs.limit(0), good).count() == 0
    assert pq.score_documents(docs, good).count() == docs.count()
