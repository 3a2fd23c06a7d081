import random
import re

import pytest

from llm_corpus import corpus, frame, with_clashes
from stratum.llm import jaccard_join as jj

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = WORD.findall((t or "").translate(LOW))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if i is None or j is None or not a or not b:
                continue
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def near_copies(seed, n, base_words=60, most=6):
    """Copies of copies with edits: many links are borderline."""
    rng = random.Random(seed)
    texts = [[f"v{rng.randrange(500)}" for _ in range(base_words)]]
    for _ in range(n - 1):
        w = list(rng.choice(texts))
        for _ in range(rng.randrange(most)):
            at = rng.randrange(len(w))
            if rng.random() < 0.5:
                w[at] = f"z{rng.randrange(10**6)}"
            else:
                w.insert(at, f"z{rng.randrange(9)}")
        texts.append(w)
    return [(10_000 + i, " ".join(w)) for i, w in enumerate(texts)]


def short_sets(seed, n):
    rng = random.Random(seed)
    return [(20_000 + i, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 24))))
            for i in range(n)]


@pytest.mark.parametrize("rounds", [jj.MAX_ROUNDS, 1])
def test_against_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(jj, "MAX_ROUNDS", rounds)   # 1: most pairs are left to the end
    rows = corpus(1, 80) + near_copies(2, 80) + near_copies(3, 60, 30, 3)[1:] + short_sets(4, 120)
    rows = list({i: (i, t) for i, t in rows}.values())
    got = jj.jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_odd_rows(spark):
    rows = corpus(5, 30) + [(None, "a b c d e f g"), (None, None)]
    rows += rows[3:6]
    got = jj.jaccard_join(with_clashes(frame(spark, rows))).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
    assert jj.jaccard_join(frame(spark, rows).limit(0)).count() == 0


def test_subset_sizes_cover_every_linked_pair():
    for n in range(1, 30):
        for m in range(n, 40):
            c = jj.least_overlap(n, m)
            if c <= n:      # such a pair can link
                assert c in jj.subset_sizes(n) and c in jj.subset_sizes(m)


def test_single_items_are_counted_over_packs_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(jj, "BUCKET_ITEMS", 50)
    rows = [(i, t or "") for i, t in corpus(7, 60)]
    df = spark.createDataFrame(rows, "_id long, _text string").repartition(4)
    sets = {i: {x for x in shingles(t)} for i, t in rows}
    seen = {}
    for i, s in sets.items():
        for x in s:
            seen.setdefault(x, set()).add(i)
    want = {}
    digests = {r["_id"]: r["_d1"] for r in jj.set_digests(df).collect()}
    for i, s in sets.items():
        n = sum(len(seen[x]) == 1 for x in s)
        if n:
            want[digests[i]] = n
    got = {r["_d1"]: r["_single"] for r in jj.single_items(df, sum(map(len, sets.values()))).collect()}
    # Cut hashes may collide, so a few single items may count as shared, none the other way.
    assert set(got) <= set(want) and all(got[d] <= want[d] for d in got)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_one_row_per_group_with_null_and_shared_ids(spark):
    rng = random.Random(4)
    a, b, c, d = (" ".join(f"{k}{rng.randrange(10**6)}" for _ in range(60)) for k in "abcd")
    rows = [(None, a)] * 3 + [(None, a + " more"), (5, a), (None, b), (None, b), (None, b + " x"),
                              (7, c), (7, d), (7, c), (8, c + " y"), (3, d + " z"),
                              (None, None), (None, None), (9, ""), (10, ""), (9, "")]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    left = jj.keep_one_per_group(df)
    assert left.columns == df.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    only_b = [t for i, t in got if i is None and t is not None]
    assert len(only_b) == 1 and only_b[0] in (b, b + " x")
    assert sorted(((i, t) for i, t in got if i is not None)) == sorted(
        [(5, a), (7, c), (3, d + " z"), (9, ""), (10, "")])
    assert got.count((None, None)) == 1 and len(got) == 7
    assert jj.keep_one_per_group(df.limit(0)).count() == 0
