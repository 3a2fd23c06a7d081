"""Each stage of the corpus pipeline on its own input, against plain Python."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from stratum.llm.common import read_table, written

import test_decontaminate as leaks
import test_jaccard_join as near
import test_secrets as secret
from test_mixing import water_fill, WORD

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "benchmark_leaks",
                                         "secret_scan", "mix_sources"]

    def step(name, docs):
        return written(stages[name](spark, docs, SF), f"test-{name}")

    clean = step("toxicity", docs)
    assert clean.columns == columns
    kept = {r.doc_id for r in clean.collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(i in kept for i, y in toxic.items() if y == 0) >= 0.95 * sum(
        y == 0 for y in toxic.values())

    one = step("near_duplicates", clean)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    groups = near.brute(rows)
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i, _, c in groups if i == c)

    left = step("benchmark_leaks", one)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in one.collect()}
    # Brute force over all windows is slow: on the documents that share a five-word run.
    grams = set().union(*[set(leaks.grams(leaks.words(t))) for _, t in items])
    near_ = [(i, t) for i, t in texts.items() if grams & set(leaks.grams(leaks.words(t)))]
    bad = {i for i, _ in leaks.brute(near_, items)}
    assert {r.doc_id for r in left.collect()} == set(texts) - bad

    masked = step("secret_scan", left)
    assert masked.columns == columns and masked.count() == left.count()
    for r in masked.collect():
        spans = secret.base(texts[r.doc_id])
        assert bool(spans) <= (cp.SECRET_MARK in r.text)
        assert r.n_chars == len(r.text) if cp.SECRET_MARK in r.text else r.text == texts[r.doc_id]
        assert not secret.base(r.text)

    mixed = step("mix_sources", masked)
    assert mixed.columns == columns + ["copy"]
    sizes = {}
    for r in masked.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    target = water_fill(sizes, (5.0, 2.0, 1.0), 3.0)
    per = {r.doc_id: (r.n, r.source) for r in mixed.groupBy("doc_id", "source").agg(
        F.count("*").alias("n")).collect()}
    for r in masked.collect():
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0.0
        n = per.get(r.doc_id, (0, None))[0]
        assert int(rate) <= n <= int(rate) + 1


def test_run_is_the_stages(spark):
    out = cp.run(spark, SF)
    assert "copy" in out.columns and out.count() > 0
    assert cp.ORACLE_SQL is None


def test_stages_on_an_empty_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").limit(0)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.count() == 0
        assert out.columns == docs.columns + (["copy"] if name == "mix_sources" else [])


def test_a_settled_result_leaves_no_tables_behind(spark):
    import os

    from stratum.llm.common import settled
    folders = []

    def make():
        a = written(spark.range(5).toDF("x"), "inner")
        folders.extend(f.rsplit("/", 1)[0].removeprefix("file:") for f in a.inputFiles())
        return written(a.where("x > 1"), "inner").where("x > 2")

    out = settled(spark, make, "outer")
    assert sorted(r.x for r in out.collect()) == [3, 4]
    assert folders and not any(os.path.exists(f.replace("//", "/")) for f in folders)
    kept = written(spark.range(2).toDF("x"), "kept")
    assert kept.count() == 2
