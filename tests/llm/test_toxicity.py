import random
import zlib

import numpy as np
import pytest

from llm_corpus import corpus, with_clashes
from stratum.llm import toxicity as tox


def test_block_max_search_equals_a_full_scan():
    rng = np.random.RandomState(1)
    n, terms = 700, 120
    vecs = []
    for i in range(n):
        t = np.sort(rng.choice(terms, rng.randint(0, 12), replace=False))
        v = rng.rand(len(t)).round(1) + 0.1
        vecs.append((t, v / np.sqrt((v * v).sum()) if len(t) else v))
    vecs += vecs[:30]                                   # ties
    dense = np.zeros((len(vecs), terms))
    for i, (t, v) in enumerate(vecs):
        dense[i, t] = v
    index = tox.BlockMaxIndex(vecs, terms)
    for q in range(0, len(vecs), 7):
        for skip in (-1, q):
            at, cos = index.nearest(*vecs[q], 15, skip=skip)
            full = dense @ dense[q]
            order = [i for i in np.lexsort((np.arange(len(full)), -full.round(12)))
                     if full[i] > 1e-15 and i != skip][:15]
            assert len(at) == len(order)
            assert np.allclose(np.sort(full[order])[::-1], cos)
            assert np.allclose(full[at], cos)


def labelled(spark, n=600, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.3)
        w = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 120))]
        if y:
            for _ in range(rng.randrange(2, 6)):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum", "moron"]) + rng.choice(["", ",", "s."]))
        docs.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, 1, y))
    truth = {i: y for (i, _), y in zip(docs, [int("idiot" in t or "scum" in t or "moron" in t)
                                              for _, t in docs])}
    docs += [(None, None), (n, ""), (n + 1, None), (n + 2, "!!! ..."), (5, "repeated id"), (5, "repeated id")]
    labels += [(None, 1, 1), (7, 1, None), (8, 0, 9), (10**6, 1, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth, len(docs))


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels, truth, n = labelled(spark)
    got = tox.score_documents(with_clashes(docs), labels).collect()
    assert len(got) == n
    right = total = 0
    for r in got:
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.held_out and r.doc_id in truth and r.doc_id != 5:
            total += 1
            right += r.predicted == truth[r.doc_id]
    assert right / total > 0.97
    again = tox.score_documents(docs.repartition(7), labels).collect()
    assert sorted((r.doc_id or -1, r.score) for r in got) == sorted(
        (r.doc_id or -1, r.score) for r in again)


def test_filter_keeps_columns(spark):
    docs, labels, truth, n = labelled(spark)
    kept = tox.keep_clean(with_clashes(docs), labels)
    assert kept.columns == with_clashes(docs).columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(y for i, y in truth.items() if i in ids) <= 0.03 * len(truth)
    assert sum(1 - y for i, y in truth.items() if i not in ids) <= 0.03 * len(truth)


@pytest.mark.parametrize("n", [600, 3000])
def test_a_rare_toxic_term_counts_at_every_size(spark, n):
    ids = [i for i in range(2 * n) if zlib.crc32(str(i).encode()) % 5][:n]
    docs = [(i, "some words " + ("moron" if k % 5 == 0 else "fine")
             + (" zyx" if k in (0, 5, 10) else "")) for k, i in enumerate(ids)]
    labels = [(i, int(k % 5 == 0)) for k, i in enumerate(ids)]
    df = spark.createDataFrame(docs + [(-1, "zyx")], "doc_id long, text string")
    got = tox.score_documents(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    row = got.where("doc_id = -1").first()
    assert set(row.evidence_ids) == {str(ids[k]) for k in (0, 5, 10)} and row.predicted == 1


def test_every_separating_term_counts(spark):
    letters = "abcdefghijklmnop"
    terms = [a + b + c for a in letters for b in letters for c in letters][:2500]
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:100]
    docs = [(i, " ".join(terms) if k % 5 == 0 else "some fine words") for k, i in enumerate(ids)]
    labels = [(i, int(k % 5 == 0)) for k, i in enumerate(ids)]
    df = spark.createDataFrame(docs + [(1000 + k, t) for k, t in enumerate(terms)],
                               "doc_id long, text string")
    got = tox.score_documents(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert got.where("doc_id >= 1000 AND size(evidence_ids) > 0").count() == len(terms)


def test_no_labels_one_class_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in tox.score_documents(docs, none).collect()} == {0.0}
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5][:20]
    many = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    one = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int")
    assert {r.predicted for r in tox.score_documents(many, one).collect()} == {1}
    assert tox.score_documents(docs.limit(0), one).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_isotonic_is_monotone(seed):
    rng = np.random.RandomState(seed)
    x = rng.rand(300)
    y = (rng.rand(300) < x).astype(float)
    cx, cy = tox.isotonic(x, y)
    assert (np.diff(cx) > 0).all() and (cy >= 0).all() and (cy <= 1).all()
    assert np.diff(cy).min() > -0.3
