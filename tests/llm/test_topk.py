import math
import random

from stratum.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    vecs = []
    for i, e, _ in rows:
        if i is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        vecs.append((i, [math.floor(1024 * x) for x in e]))
    out = []
    for row, (q, v) in enumerate(vecs):
        if q % every:
            continue
        hits = sorted((-sum(a * b for a, b in zip(v, e)), i) for other, (i, e) in enumerate(vecs)
                      if other != row and len(e) == len(v))[:k]
        out += [(q, r, i, -s if abs(s) < 1 << 63 else None) for r, (s, i) in enumerate(hits, 1)]
    return sorted(out, key=str)


def rows_of(seed, n, dims=8, grid=None):
    rng = random.Random(seed)
    val = (lambda: rng.choice(grid)) if grid else (lambda: rng.gauss(0, 0.3))
    # float32 values, as the table stores them
    import struct
    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    return [(i, [f32(val()) for _ in range(dims)], 0) for i in range(n)]


def test_matches_brute_force_with_ties_and_odd_vectors(spark):
    for rows in (rows_of(1, 300), rows_of(2, 300, grid=[0.0, 0.5, -0.5])):
        rows += [(1000, None, 1), (1100, [], 1), (1200, [1.0, None] * 4, 1), (None, [1.0] * 8, 0),
                 (1300, [float("nan")] * 8, 0), (1400, [float("inf")] * 8, 0),
                 (1500, [0.0] * 8, 0), (1600, [1.0, 2.0], 0), (1700, [1.0] * 8, None)]
        rows += [(2000 + i, [0.25] * 8, 0) for i in range(150)]      # one hot vector
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        got = top_k(df, k=10, every=50, block_rows=100, query_rows=3)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 10, 50)


def test_fewer_candidates_than_k_and_empty(spark):
    rows = rows_of(3, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, top_k(df, every=2).collect()), key=str) == brute(rows, 10, 2)
    assert top_k(df.limit(0)).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = rows_of(4, 120) + [(100, [0.5] * 8, 0), (100, [0.5] * 8, 0), (100, [-0.5] * 8, 0),
                              (7, [0.25] * 8, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr(
        "*", "'clash' AS _row", "'clash' AS _id", "'clash' AS score", "'clash' AS _v")
    got = sorted(map(tuple, top_k(df, every=50, block_rows=40).collect()), key=str)
    assert got == brute(rows, 10, 50)
    assert sum(r[0] == 100 for r in got) == 4 * 10


def test_large_components(spark):
    rows = rows_of(5, 200, dims=4)
    rows += [(1000 + 50 * i, [x * 2.0 ** e for x in v], 0)
             for i, (e, (_, v, _)) in enumerate(zip((18, 20, 30, 40, 45), rows_of(6, 5, dims=4)))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, top_k(df, every=50, block_rows=64).collect()), key=str)
    assert got == brute(rows, 10, 50)
    assert any(r[3] is None for r in got) and any((r[3] or 0) > 1 << 53 for r in got)


def test_bounds_exclude_rows_before_the_lists_are_read(spark):
    import numpy as np

    from stratum.llm import topk
    rng = np.random.RandomState(1)
    x = (rng.randn(3000, 6) * [900, 40, 10, 5, 3, 2]).astype(np.int64)
    block = topk.Block(np.arange(3000), np.arange(3000), x)
    alive = np.ones((20, 3000), bool)
    steps = topk.STEPS
    topk.STEPS = steps[:2]
    try:
        block._narrow(x[:20].astype(float), alive, 10)
    finally:
        topk.STEPS = steps
    assert alive.sum(axis=1).max() < 1000
    for q, left in zip(x[:20], alive):
        assert set(np.argsort(-(x @ q), kind="stable")[:10]) <= set(np.flatnonzero(left))
