import hashlib
import os

import pytest

from stratum.llm import warc
from stratum.llm.common import scratch_uri

SCHEMA = "page_id long, url string, html string"


def pages(n=300):
    rows = [(i, f"http://h{i % 5}.example.org/{i}", ("<p>é%d</p>" % (i % 40)) * (1 + i % 40))
            for i in range(n)]
    rows += [(1000, "http://a/", None), (1001, None, ""), (1002, "bad\r\nurl", "x" * 5000),
             (1003, "u", "same " * 30), (5, "u2", "same " * 30), (None, "u3", "same " * 30),
             (1004, "u", "short"), (1005, "u", "short"), (1006, "u", "z" * 100),
             (1006, "u", "z" * 100), (1007, "v", "z" * 100), (None, "n", "only null " * 20),
             (None, "m", "only null " * 20), (None, "n", "only null " * 20)]
    return rows


def expected(rows):
    digest = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
    order = sorted(range(len(rows)), key=lambda k: (
        rows[k][0] is None, rows[k][0] or 0, digest(rows[k][2]), rows[k][1] or ""))
    lead, out = {}, []
    for k in order:
        lead.setdefault(digest(rows[k][2]), k)
    for k, (i, _, h) in enumerate(rows):
        b = (h or "").encode()
        d = digest(h)
        rev = len(b) >= 100 and lead[d] != k
        out.append((i, len(b), d, "revisit" if rev else "response", rows[lead[d]][0] if rev else None))
    return out


def key(r):
    return [(x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r]


@pytest.mark.parametrize("shard,file", [(1 << 30, 1 << 30), (20_000, 3_000)])
def test_round_trip_revisits_and_determinism(spark, shard, file):
    rows = pages()
    shas = []
    for parts in (3, 7):
        root = scratch_uri(spark, "warc-test")
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        m = warc.write_warc(df, root, shard_bytes=shard, file_bytes=file).collect()
        shas.append(sorted((r.name, r.sha256, r.records, r.bytes) for r in m))
        got = [tuple(r) for r in warc.read_warc(spark, root).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(got, key=key) == sorted(expected(rows), key=key)
        assert all(r.bytes <= file or r.records == 1 for r in m)
    assert shas[0] == shas[1]                     # equal files whatever the partitioning
    assert len(shas[0]) > (1 if shard < 1 << 20 else 0)


def test_files_hold_what_the_manifest_says_and_payloads_come_back(spark):
    root = scratch_uri(spark, "warc-test")
    m = warc.write_warc(spark.createDataFrame(pages(), SCHEMA), root).collect()
    fs, base = warc.open_fs(root)
    for r in m:
        with fs.open_input_stream(f"{base}/{r.name}", compression=None) as f:
            data = f.read()
        assert hashlib.sha256(data).hexdigest() == r.sha256 and len(data) == r.bytes
    responses = {}
    for r in m:
        with fs.open_input_stream(f"{base}/{r.name}", compression=None) as f:
            for raw in warc.members(f, 1000):
                rec = warc.parse_record(raw)
                if rec["h"]["WARC-Type"] == "response":
                    responses[rec["h"]["X-Page-Id"]] = rec["block"]
    assert responses["1002"] == b"x" * 5000 and responses["1000"] == b""


def test_unpublished_files_are_not_read(spark):
    root = scratch_uri(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(pages(20), SCHEMA), root)
    n = warc.read_warc(spark, root).count()
    fs, base = warc.open_fs(root)
    os.makedirs(f"{base}/_tmp", exist_ok=True)
    for name in (f"{base}/_tmp/9-9-dead-0-0.part", f"{base}/warc-000009-00009.warc.gz"):
        with fs.open_output_stream(name) as f:
            f.write(b"left by a lost executor")
    assert warc.read_warc(spark, root).count() == n


def test_empty_table(spark):
    root = scratch_uri(spark, "warc-test")
    assert warc.write_warc(spark.createDataFrame([], SCHEMA), root).count() == 0
    assert warc.read_warc(spark, root).count() == 0


def test_hot_ids_are_split(spark, monkeypatch):
    monkeypatch.setattr(warc, "RUN", 20)                    # read on the driver
    rows = [(None, f"u{i % 3}", "hot payload " * 30) for i in range(400)]          # equal rows
    rows += [(7, None, f"body {i} " * 40) for i in range(300)]                     # one id
    rows += [(i * 10**15, "u", f"page {i} " * 30) for i in range(100)]             # wide ids
    rows += [(2**63 - 1, "max", "x" * 200), (-2**63, "min", "y" * 200)]
    shas = []
    for parts in (2, 5):
        root = scratch_uri(spark, "warc-test")
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        m = warc.write_warc(df.selectExpr("*", "1 AS _id", "'c' AS _shard"), root,
                            shard_bytes=10_000, file_bytes=1 << 20).collect()
        shas.append(sorted((r.name, r.sha256, r.records) for r in m))
        got = [tuple(r) for r in warc.read_warc(spark, root).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(got, key=key) == sorted(expected(rows), key=key)
        assert max(r.records for r in m) < 200           # no file holds a hot id whole
    assert shas[0] == shas[1]


def test_levels_stay_few(spark):
    from pyspark.sql import functions as F
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 10**9).alias("_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("_digest"), F.lit(1000).alias("_size"))
    cells = warc.cells_of(facts, 20_000)
    assert len(cells.levels) <= 5 and 120 <= cells.n_shards <= 400
    placed = warc._placed(facts, cells)
    assert placed.count() == 3000
    assert placed.groupBy("_shard").sum("_size").agg({"sum(_size)": "max"}).first()[0] <= 40_000


def test_copies_of_one_record_are_a_leaf_at_once(spark):
    from pyspark.sql import functions as F
    facts = spark.range(500).select(
        F.lit(5).cast("long").alias("_id"), F.sha2(F.lit("x"), 256).alias("_digest"),
        F.lit(1000).alias("_size"))
    far = spark.range(2).selectExpr("id * 9000000000000000 AS _id", "sha2('y', 256) AS _digest",
                                    "1000 AS _size")
    cells = warc.cells_of(facts.unionByName(far), 20_000)
    assert len(cells.levels) <= 3 and max(cells.split.values()) == 25
    assert warc._placed(facts.unionByName(far), cells).count() == 502
