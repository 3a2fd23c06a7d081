import random
import re
from collections import Counter

from llm_corpus import corpus, with_clashes
from stratum.llm import decontaminate as dec


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def grams(w):
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def similar(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(docs, items):
    out = set()
    for i, t in docs:
        w = words(t)
        for j, u in items:
            v = words(u)
            if not v or not w:
                continue
            g, n = grams(v), len(v)
            size = min(5, n)
            best = 0.0
            for k in range(max(1, len(w) - n + 1)):
                part = w[k:k + n]
                have = Counter(tuple(part[x:x + size]) for x in range(len(part) - size + 1))
                best = max(best, similar(have, g))
            if best >= 0.8:
                out.add((i, j))
    return out


def fixture(seed=1):
    rng = random.Random(seed)
    prose = lambda n: [f"p{rng.randrange(3000)}" for _ in range(n)]
    items = [(j, " ".join(prose(rng.choice([20, 40, 60, 90])))) for j in range(20)]
    items += [(100, "tiny item"), (101, None), (102, ""), (103, items[3][1]), (None, "null id item of six words")]
    docs = [(i, t if t is None else t[:4000]) for i, t in corpus(seed, 40)]
    n = 1000
    for j, t in items[:20]:
        for edits in (0, 1, 2, 4):
            w = t.split()
            for _ in range(edits):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([["zz"], [], [w[at], "ins"]])
            text = " ".join(prose(30) + [x.upper() + rng.choice(["", ",", "."]) for x in w] + prose(30))
            docs.append((n, text))
            n += 1
        half = t.split()[: len(t.split()) // 2]
        docs.append((n, " ".join(prose(10) + half + prose(10))))
        n += 1
    docs += [(n, items[0][1]), (n + 1, " ".join(items[1][1].split()[:-1])), (n + 2, "a tiny item here"),
             (None, items[2][1]), (n + 3, items[4][1] + " " + items[5][1]), (n, items[0][1])]
    return docs, items


def test_against_brute_force(spark):
    docs, items = fixture()
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    it = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = dec.find_leaks(df, it).collect()
    have, want = {(r.doc_id, r.item_id) for r in got}, brute(docs, items)
    assert have == want
    assert all(r.similarity >= 0.8 and r.hamming <= 20 for r in got)
    left = dec.remove_leaking(df, it)
    assert left.columns == df.columns
    bad = {i for i, _ in want}
    assert sorted((str(r.doc_id) for r in left.collect())) == sorted(
        str(i) for i, _ in docs if i not in bad)


def test_short_documents_with_punctuation_around(spark):
    items = [(1, " ".join(f"a{i}" for i in range(15))), (2, " ".join(f"b{i}" for i in range(38)))]
    a, b = items[0][1].split(), items[1][1].split()
    docs = [(1, " ".join(a[:13]) + "."), (2, '"' + " ".join(b[:32]) + '."'),
            (3, "- " + " ".join(a[2:])), (4, "... " + " ".join(a) + " !"),
            (5, " ".join(a[:11]) + "."), (6, " ".join(b[:32]) + "."), (7, "..."), (8, None)]
    got = dec.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items) == {
        (1, 1), (2, 2), (3, 1), (4, 1), (6, 2)}
    by = {r.doc_id: r for r in got}
    assert abs(by[1].similarity - 9 / 11) < 1e-12 and abs(by[2].similarity - 28 / 34) < 1e-12
    assert by[4].similarity == 1.0 and by[4].word_start == 0


def test_blocks_guarantee_every_fingerprint_within_the_radius():
    rng = random.Random(3)
    for radius in (0, 3, 20):
        cut = dec.blocks(radius)
        assert sum(w for _, w in cut) == 64 and len(cut) == radius + 1
        for _ in range(200):
            flip = sum(1 << b for b in rng.sample(range(64), radius))
            assert any((flip >> o) & ((1 << w) - 1) == 0 for o, w in cut)


def test_simhash_equals_python(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(["a", "b", "c", "a"],), (["x"],), (["q"] * 300,)], "w array<string>")
    df = dec.fingerprinted(df, "w").withColumn(
        "h", F.transform("w", lambda x: F.xxhash64(x)))
    for r in df.collect():
        want = 0
        for b in range(64):
            ones = sum((h >> b) & 1 for h in r.h)
            want |= (2 * ones > len(r.h)) << b
        assert r["_fp"] % (1 << 64) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dec.find_leaks(docs.limit(0), items).count() == 0
    assert dec.find_leaks(docs, items.limit(0)).count() == 0
    assert dec.find_leaks(docs, items).count() == 1
    assert dec.remove_leaking(docs, items.limit(0)).count() == 1
