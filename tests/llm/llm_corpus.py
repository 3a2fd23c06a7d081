"""Small corpora with planted copies, and the odd rows every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocab=200):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def corpus(seed=1, n=120):
    """(doc_id, text) rows: prose, exact and near copies, shared passages, odd texts."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    base = words(rng, 150)
    texts = []
    for i in range(n):
        kind = i % 8
        if kind == 0 and texts:
            texts.append(rng.choice([t for t in texts if t] or ["x"]))
        elif kind == 1:
            w = words(rng, rng.randrange(5, 120))
            at = rng.randrange(len(w))
            texts.append(" ".join(w[:at] + passage + w[at:]))
        elif kind == 2:
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(w))
        elif kind == 3:
            texts.append(" ".join(words(rng, rng.randrange(0, 12), 4)))
        elif kind == 4:
            texts.append("\n".join(["same line again"] * rng.randrange(1, 40)))
        else:
            texts.append("\t ".join(words(rng, rng.randrange(1, 200), 3000)))
    texts += [None, "", "   \n\t", "é" * 50, "Ünïcode wörds " * 30, "a", "A", "one two",
              "ONE two", " ".join(words(rng, 4000, 50000)), "x " * 3000]
    return list(enumerate(texts))


def frame(spark, rows, partitions=5):
    """A documents table; with a clashing extra column for each working name."""
    rows = [(i, t, "en", None if k % 7 == 0 else f"src{k % 3}", None if t is None else len(t))
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def with_clashes(df):
    from pyspark.sql import functions as F
    for name in ("_id", "_tk", "_text", "n_words", "score", "_n", "_item", "copy", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    return df
