import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_corpus import corpus, frame, with_clashes
from stratum.llm import importance as im

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_run):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + r]) for r in range(1, max_run + 1)
                    for i in range(len(w) - r + 1)]


def brute(docs, target, buckets=10000, max_run=2, percent=25, min_words=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, max_run)[1])
    t = Counter(bucket(f) for x in target for f in features(x, max_run)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for i, x in docs:
        n_words, f = features(x, max_run)
        weight = sum(gain(bucket(y)) for y in f) // len(f) if f else 0
        key = f"{seed}:{'null' if i is None else i}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))
        rows.append([i, len(f), weight, score, None, n_words])
    able = sorted((r for r in rows if r[5] >= min_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in rows]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_span_crc_equals_zlib():
    rng = random.Random(3)
    data = np.frombuffer(bytes(rng.randrange(256) for _ in range(60000)), np.uint8)
    spans = [(rng.randrange(50000), n) for n in
             [1, 2, 3, 63, 64, 65, 127, 128, 129, 191, 192, 193, 4095, 4096, 4097, 9999]
             for _ in range(5)]
    spans += [(rng.randrange(50000), rng.randrange(1, 400)) for _ in range(500)]
    for group in (spans, [s for s in spans if s[1] <= 64], []):
        start = np.array([a for a, _ in group], np.int64)
        end = start + np.array([n for _, n in group], np.int64)
        assert im.span_crc(data, start, end).tolist() == [
            zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]


def test_groups_are_bounded(monkeypatch):
    data = np.frombuffer(("word " * 2000 + "x" * 9000).encode(), np.uint8)
    start, end = np.array([0, 5, 10000]), np.array([9999, 9, 19000])
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]
    monkeypatch.setattr(im, "GROUP", 100)
    assert im.span_crc(data, start, end).tolist() == want


@pytest.mark.parametrize("kw", [{}, {"buckets": 97, "max_run": 3, "percent": 60, "min_words": 2,
                                     "seed": 11}])
def test_equals_brute_force(spark, kw):
    rows = corpus(4) + [(None, "no id " * 15), (None, "no id " * 15), (3, "a third of ids " * 9),
                        (3, "a third of ids " * 9), (900, "X" * 9000 + " " + "yz " * 30)]
    rows += [(None, "hot row " + " ".join(f"h{i}" for i in range(30)))] * 60
    target = [t for _, t in corpus(5, 40)] + [None, ""]
    docs = with_clashes(frame(spark, rows).withColumnRenamed("n_chars", "_row"))
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = im.importance_resample(docs, goal, **kw)
    have = sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score",
                                        "rank").collect()), key=key)
    assert have == sorted(brute(rows, target, **kw), key=key)
    again = im.importance_resample(docs.repartition(3), goal, **kw)
    assert sorted(map(tuple, again.select("doc_id", "n_features", "weight", "score",
                                          "rank").collect()), key=key) == have


def test_drawn_documents_keep_their_columns(spark):
    docs = frame(spark, [(i, t) for i, t in corpus(6) if i is not None])
    got = im.importance_resample(docs, docs.where("doc_id < 20"))
    drawn = im.drawn_documents(docs, got)
    assert drawn.columns == docs.columns
    assert drawn.count() == got.where("rank IS NOT NULL").count() > 10


def test_empty_tables(spark):
    docs = frame(spark, corpus(7, 30))
    none = docs.limit(0)
    assert im.importance_resample(none, docs).count() == 0
    assert im.importance_resample(docs, none).count() == docs.count()
    short = docs.where("doc_id % 8 = 3")
    assert im.importance_resample(short, docs).where("rank IS NOT NULL").count() == 0
