import random
import re

import pytest

from llm_corpus import corpus, frame, with_clashes
from stratum.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights, most):
    """{source: target} by resharing the excess until no source is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + (
        [None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        rest = [s for s in order if s not in full]
        if not rest or left <= 0:
            return {s: full.get(s, 0.0) for s in order}
        level = left / sum(w[s] for s in rest)
        over = [s for s in rest if w[s] * level > most * sizes[s]]
        if not over:
            return full | {s: w[s] * level for s in rest}
        full |= {s: float(most * sizes[s]) for s in over}


def check(spark, df, rows, sources):
    got = mixing.plan_mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for (i, t), s in zip(rows, sources):
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = water_fill(sizes, (5.0, 2.0, 1.0), 3.0)
    for r in got:
        s = r["source"]
        assert r["_ssize"] == sizes[s]
        assert r["_target"] == pytest.approx(want[s], rel=1e-9)
        rate = want[s] / sizes[s] if sizes[s] else 0.0
        assert int(rate) <= r["_copies"] <= int(rate) + (rate > int(rate))
        assert r["_copies"] <= 3
    return got


def test_targets_and_copies(spark):
    rows = corpus(1, 200)
    sources = [None if k % 7 == 0 else f"src{k % 3}" for k in range(len(rows))]
    df = frame(spark, rows)
    got = check(spark, df, rows, sources)
    again = mixing.plan_mix(frame(spark, rows, 3)).collect()
    assert sorted((r.doc_id, r["_copies"]) for r in got) == sorted(
        (r.doc_id, r["_copies"]) for r in again)
    out = mixing.mix(df)
    assert out.columns == df.columns + ["copy"]
    per = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert per == {r.doc_id: r["_copies"] for r in got if r["_copies"]}


def test_full_sources_pass_their_excess_on(spark):
    rows = [(i, "w " * n) for i, n in enumerate([10, 1000, 2000, 5, 0])]
    df = spark.createDataFrame([(i, t, s) for (i, t), s in zip(rows, "abcde")],
                               "doc_id long, text string, source string")
    check(spark, df, rows, list("abcde"))


def test_odd_tables(spark):
    rows = [(None, None), (None, "a b"), (1, ""), (1, "x y z"), (1, "x y z")]
    df = with_clashes(frame(spark, rows))
    assert mixing.plan_mix(df).count() == 5
    out = mixing.mix(df.withColumn("_size", df.n_chars))
    assert out.columns == [*df.columns, "_size", "copy_"]          # input columns stay
    assert {r["copy"] for r in out.collect()} == {"clash"}
    assert dict(out.dtypes)["copy_"] == "bigint"
    assert mixing.plan_mix(df.limit(0)).count() == 0
    assert mixing.mix(df.limit(0)).count() == 0


def test_rows_without_an_id_or_with_a_shared_one(spark):
    rng = random.Random(5)
    rows = [(i if i % 3 else (None if i % 2 else 77), " ".join(["w"] * rng.randrange(1, 9)),
             "abc"[rng.randrange(20) % 3 if rng.random() < 0.5 else 0]) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan_mix(df.repartition(5)).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r["_size"] * r["_copies"]
        target[r.source] = r["_target"]
    for s in target:
        assert taken[s] == pytest.approx(target[s], rel=0.02)
    key = lambda rows: sorted((str(r.doc_id), r.text, r.source, r["_copies"]) for r in rows)
    only = [r for r in got if r.source == "a"]
    again = mixing.plan_mix(df.repartition(9)).where("source = 'a'").collect()
    assert len(only) == len(again)
    # Equal rows draw the same coins in every run; who gets which does not matter.
    a, b = key(got), key(mixing.plan_mix(df.coalesce(1)).collect())
    plain = lambda x: sorted((i, t, c) for i, t, _, c in x)
    assert sum(c for *_, c in plain(a)) == pytest.approx(sum(c for *_, c in plain(b)), rel=0.01)


def test_equal_rows_draw_the_same_coins_in_every_run(spark):
    rows = [(None, "a b c", "x")] * 900 + [(4, "d e", "x")] * 50 + [
        (100 + i, "w " * (i % 5), "y") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted((str(r.doc_id), r.text, r["_copies"]) for r in
                   mixing.plan_mix(df.repartition(n)).collect()) for n in (1, 4, 7)]
    assert runs[0] == runs[1] == runs[2]
    copies = {r[2] for r in runs[0] if r[0] == "None"}
    assert len(copies) == 2                                   # coins differ among equal rows
