import math
import struct

import numpy as np
import pytest

from stratum.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int"


def f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def rows_of(seed, n, dims, stretch=None):
    rng = np.random.RandomState(seed)
    turn = np.linalg.qr(rng.randn(dims, dims))[0]
    width = stretch if stretch is not None else np.linspace(3, 0.3, dims)
    x = (rng.randn(n, dims) * width) @ turn + rng.rand(dims)
    return [(i, [f32(v) for v in r], 0) for i, r in enumerate(x.tolist())]


def brute(rows, components=32):
    """(ids, n, deviations, whitened, explained) from exact integers."""
    ok = [(i, e) for i, e, _ in rows
          if e and all(v is not None and math.isfinite(v) for v in e)]
    x = [[math.floor(64 * v) + 1_000_000 for v in e] for _, e in ok]
    n, dims = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(dims)]
    dev = [sum((n * r[k] - s[k]) ** 2 for k in range(dims)) for r in x]
    c = np.array([[(n * r[k] - s[k]) / n for k in range(dims)] for r in x])
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return [i for i, _ in ok], n, dev, c @ q / np.sqrt(e), e / (c * c).sum() * n


def check(got, rows, components=32):
    ids, n, dev, want, explained = brute(rows, components)
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == sorted(
        (i is None, i or 0) for i in ids)
    order = lambda i, d: (i is None, i or 0, d)
    got = sorted(got, key=lambda r: order(r.vec_id, r.deviation))
    at = sorted(range(len(ids)), key=lambda k: order(ids[k], dev[k]))
    assert [r.deviation for r in got] == [dev[k] for k in at]
    assert {r.n for r in got} == {n}
    y = np.array([r.whitened for r in got])
    want = want[at]
    sign = np.sign((y * want).sum(axis=0))
    assert np.abs(y * sign - want).max() < 1e-7
    assert np.allclose(got[0].explained, explained, rtol=1e-9)
    assert got[0].identity_error <= 1e-9
    assert np.abs(y.T @ y / n - np.eye(y.shape[1])).max() <= 1e-9


@pytest.mark.parametrize("dims,n", [(1, 12), (5, 40), (40, 300)])
def test_rank_one_updates_rebuild_the_scatter(dims, n):
    rng = np.random.RandomState(dims)
    for x in (rng.randn(n, dims) * rng.rand(dims) * 9, np.round(rng.randn(n, dims)),
              np.repeat(rng.randn(4, dims), n // 4, axis=0)):
        s = wh.empty_spectrum(dims)
        for r in x:
            s = wh.rank_one(*s, r)
            assert (np.diff(s[0]) >= 0).all()
        full = x.T @ x
        size = np.abs(full).max()
        assert np.abs(s[1] @ np.diag(s[0]) @ s[1].T - full).max() < 1e-12 * size
        assert np.abs(s[1].T @ s[1] - np.eye(dims)).max() < 1e-11
        half = n // 2
        a, b = wh.empty_spectrum(dims), wh.empty_spectrum(dims)
        for r in x[:half]:
            a = wh.rank_one(*a, r)
        for r in x[half:]:
            b = wh.rank_one(*b, r)
        both = wh.combine(a, b)
        assert np.abs(both[1] @ np.diag(both[0]) @ both[1].T - full).max() < 1e-12 * size


def test_equals_full_decomposition(spark):
    rows = rows_of(1, 700, 40)
    rows += [(1000, None, 0), (1001, [], 0), (1002, [None] + [1.0] * 39, 0),
             (1003, [float("nan")] * 40, 0), (1004, [float("inf")] * 40, 0)]
    rows += [(None, rows[3][1], 0), (3, rows[4][1], 0)]                  # ids do not matter
    rows += [(2000 + i, rows[5][1], 0) for i in range(300)]              # one hot vector
    df = spark.createDataFrame(rows, SCHEMA).repartition(11).selectExpr(
        "*", "'clash' AS _id", "'clash' AS _v", "'clash' AS n", "1 AS whitened")
    got = wh.whiten(df).collect()
    check(got, rows)
    each = wh.per_component(wh.whiten(df.select("vec_id", "embedding")))
    assert each.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                            "identity_error"]
    assert each.count() == 32 * len(got)
    assert each.agg({"component": "min"}).first()[0] == 1


def test_fewer_dimensions_than_components_and_stretched_spectra(spark):
    for rows in (rows_of(2, 200, 7), rows_of(3, 400, 12, np.geomspace(300, 0.5, 12))):
        check(wh.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect(), rows)


def test_dependent_dimensions_have_no_component(spark):
    rows = [(i, [*v, v[0], 2.5], 0) for i, v, _ in rows_of(4, 60, 3)]
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all([w is None for w in r.whitened] == [False] * 3 + [True] * 2 for r in got)
    assert got[0].identity_error <= 1e-9
    one = wh.whiten(spark.createDataFrame(rows[:1], SCHEMA)).collect()
    assert one[0].whitened == [None] * 5 and one[0].identity_error is None
    assert one[0].deviation == 0


def test_lengths_are_lists_of_their_own_and_large_entries_stay_exact(spark):
    small = rows_of(5, 50, 4)
    large = [(100 + i, [f32((i - 20) * 1e16), f32((i * i) % 7 * 1e3)], 0) for i in range(40)]
    got = wh.whiten(spark.createDataFrame(small + large, SCHEMA).repartition(4)).collect()
    check([r for r in got if r.dims == 4], small)
    two = {r.vec_id: r for r in got if r.dims == 2}
    x = [[math.floor(64 * v) + 1_000_000 for v in e] for _, e, _ in large]
    s = [sum(c) for c in zip(*x)]
    for (i, _, _), r in zip(large, x):
        d = sum((40 * v - t) ** 2 for v, t in zip(r, s))
        assert two[i].deviation == (d if d < 1 << 63 else None)
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
