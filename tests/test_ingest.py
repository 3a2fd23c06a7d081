"""Ingest by the files of each micro-batch: late files, headers, rescue, crashes, bounds."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from stratum.sources import files
from stratum.sources.registry import SourceSpec
from stratum.sources.tables import Layout
from stratum.streaming import flows, publish
from stratum.streaming.flows import FlowOptions


def source(layout, name, fmt, **options):
    s = SourceSpec(name, os.path.join(layout.root, "landing", name), fmt,
                   layout.schema_location(name), options=options)
    os.makedirs(s.source_path)
    return s


def put(s, name, text, age=0):
    """A landing file, ``age`` seconds old."""
    path = os.path.join(s.source_path, name)
    with open(path + ".tmp", "w") as f:
        f.write(text)
    at = time.time() - age
    os.utime(path + ".tmp", (at, at))
    os.rename(path + ".tmp", os.path.join(s.source_path, name))


def bronze(spark, layout, name):
    return flows.bronze_table(spark, layout, name)


def test_json_columns_of_a_file_with_an_older_time(spark, run_dir):
    layout = Layout(run_dir)
    for multiline, wrap in ((True, "[%s]"), (False, "%s")):
        s = source(layout, f"j{multiline}", "json", multiline=multiline)
        put(s, "a.json", wrap % '{"id": 1}')
        flows.ingest(spark, layout, s)
        put(s, "b.json", wrap % '{"id": 2, "device": "ios"}', age=7200)
        # (Spark cannot infer multi-line files whose names hold pattern characters.)
        put(s, "old.json" if multiline else "old [1] {x}.json", wrap % '{"id": 3, "zone": 7}',
            age=400 * 86400)
        flows.ingest(spark, layout, s)
        rows = {r.id: r for r in bronze(spark, layout, s.source_name).collect()}
        assert rows[2].device == "ios" and rows[3].zone == 7 and rows[1].device is None
        assert all(r._rescued_data is None for r in rows.values())


def test_json_column_that_lands_while_the_stream_runs(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "live", "json")
    put(s, "a.json", '[{"id": 1}]')
    q = flows.ingest(spark, layout, s, FlowOptions(processing_time="1 second"))
    try:
        put(s, "b.json", '[{"id": 2, "device": "ios"}]', age=3600)
        time.sleep(1)
        q.processAllAvailable()
        put(s, "c.json", '[{"id": 3, "device": "web", "n": 1.5}]')
        time.sleep(1)
        q.processAllAvailable()
    finally:
        q.stop()
    rows = {r.id: r for r in bronze(spark, layout, "live").collect()}
    assert (rows[1].device, rows[2].device, rows[3].device, rows[3].n) == (None, "ios", "web", 1.5)


def test_csv_by_name(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "shop", "csv")
    put(s, "a.csv", "id,cat,code\n1,toys,007\n")
    flows.ingest(spark, layout, s)
    put(s, "b.csv", "cat,id,code\nbooks,2,011\n", age=7200)            # reordered, older
    put(s, "c.csv", 'extra,"id",CODE,\n5,3,1.50,blank\n')              # extra, other case, blank
    put(s, "d.csv", "\ncat,cat,id\nx,y,4\n")                           # a blank line, repeated
    put(s, "e.csv", "id,cat\n5,z,SURPLUS\n")
    put(s, "empty.csv", "")
    flows.ingest(spark, layout, s)
    df = bronze(spark, layout, "shop")
    types = dict(df.dtypes)
    assert types["id"] == "int" and types["code"] == "string" and types["extra"] == "int"
    rows = {r.id: r for r in df.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert (rows[1].cat, rows[1].code) == ("toys", "007")
    assert (rows[2].cat, rows[2].code, rows[2]._rescued_data) == ("books", "011", None)
    assert (rows[3].extra, rows[3].code, rows[3]._c3, rows[3].cat) == (5, "1.50", "blank", None)
    assert (rows[4].cat, rows[4].cat1) == ("x", "y")
    assert json.loads(rows[5]._rescued_data) == {"_surplus_values": "5,z,SURPLUS"}


def test_csv_types_and_no_pass_for_known_columns(spark, run_dir, monkeypatch):
    layout = Layout(run_dir)
    s = source(layout, "typed", "csv", delimiter=";")
    put(s, "a.csv", "i;l;d;b;t;z;n;q\n1;3000000000;1.5;true;2024-01-05;01;;a\n-2;1;2e3;FALSE;x;1;;b\n")
    flows.ingest(spark, layout, s)
    assert dict(bronze(spark, layout, "typed").dtypes) | {
        "i": "int", "l": "bigint", "d": "double", "b": "boolean", "t": "string", "z": "string",
        "n": "string", "q": "string"} == dict(bronze(spark, layout, "typed").dtypes)
    reads = []
    real = files._csv_text
    monkeypatch.setattr(files, "_csv_text", lambda *a: reads.append(a[3]) or real(*a))
    put(s, "b.csv", "q;i\nc;x7\n")
    put(s, "c.csv", "new;i\n5;8\n")
    flows.ingest(spark, layout, s)
    read = [p for r in reads for p in r]
    assert sorted(read.count(p) for p in set(read)) == [2, 2]     # typing ``new``, then reading
    reads.clear()
    put(s, "d.csv", "i;new\n9;6\n")
    flows.ingest(spark, layout, s)
    assert sum(len(r) for r in reads) == 1                        # known columns only: one read
    rows = {r.q or r.new: r for r in bronze(spark, layout, "typed").collect()}
    assert rows["c"].i is None and json.loads(rows["c"]._rescued_data) == {"i": "x7"}
    assert rows[5].i == 8 and rows[6].i == 9


def test_csv_without_header(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "bare", "csv", header=False)
    put(s, "a.csv", "1,x\n2,y\n")
    flows.ingest(spark, layout, s)
    assert sorted((r._c0, r._c1) for r in bronze(spark, layout, "bare").collect()) == [
        (1, "x"), (2, "y")]


def test_rescue_mode_keeps_unknown_keys(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "fixed", "json", evolution="rescue", multiline=False)
    put(s, "a.json", '{"id": 1, "name": "x"}\n')
    flows.ingest(spark, layout, s)
    put(s, "b.json", '{"id": 2, "device": "ios", "geo": {"lat": 1}}\n{"id": 3}\n{"id": "no", "n": 1}\n')
    put(s, "c.json", '{"id": 5, "Name": "other case"}\n')
    put(s, "d.json", '{"id": 6}\nnot json\n{"id": 7, "name"\n')
    flows.ingest(spark, layout, s)
    df = bronze(spark, layout, "fixed")
    assert df.columns[:2] == ["id", "name"] and "device" not in df.columns
    rows = df.collect()
    rescued = {r.id: json.loads(r._rescued_data) for r in rows if r._rescued_data}
    assert rescued[2] == {"device": "ios", "geo": '{"lat":1}'}
    assert rescued[5] == {"Name": "other case"}
    by_text = sorted(json.loads(r._rescued_data)["_corrupt_record"] for r in rows
                     if r._rescued_data and "_corrupt_record" in r._rescued_data)
    assert by_text == ["not json", '{"id": 7, "name"']
    assert {"id": "no", "n": "1"} in [json.loads(r._rescued_data) for r in rows if r._rescued_data]
    assert len(rows) == 8
    c = source(layout, "fixed_csv", "csv", evolution="rescue")
    put(c, "a.csv", "id,cat\n1,x\n")
    flows.ingest(spark, layout, c)
    put(c, "b.csv", "zone,id\nEU,2\n")
    flows.ingest(spark, layout, c)
    got = {r.id: r for r in bronze(spark, layout, "fixed_csv").collect()}
    assert json.loads(got[2]._rescued_data) == {"zone": "EU"} and got[2].cat is None


def test_keys_that_differ_in_case_are_rescued(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "cases", "json")
    put(s, "a.json", '[{"id": 1, "device": "ios", "Device": "IOS"}]')
    put(s, "b.json", '[{"ID": 9, "device": "web"}]')
    flows.ingest(spark, layout, s)
    rows = bronze(spark, layout, "cases").collect()
    text = {r._source_file: str(r.asDict()) for r in rows}     # as a column, or rescued
    assert len(rows) == 2
    assert all(v in text["a.json"] for v in ("ios", "IOS"))
    assert "9" in text["b.json"] and "web" in text["b.json"]


def test_large_array_is_refused_by_name(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "big", "json", max_document_bytes=60)
    put(s, "a.json", '[{"id": 1}]')
    flows.ingest(spark, layout, s)
    put(s, "huge.json", "[" + ",".join('{"id": 2}' for _ in range(20)) + "]")
    with pytest.raises(Exception, match="huge.json"):
        flows.ingest(spark, layout, s)
    wide = SourceSpec(s.source_name, s.source_path, "json", s.schema_location,
                      options={"max_document_bytes": 1000})
    flows.ingest(spark, layout, wide)                      # the same batch, run again
    assert bronze(spark, layout, "big").count() == 21


@pytest.mark.parametrize("stop", ["before the manifest", "while moving", "before the mark"])
def test_a_batch_is_appended_once(spark, run_dir, monkeypatch, stop):
    layout = Layout(run_dir)
    s = source(layout, "once", "json")
    for i in range(4):
        put(s, f"{i}.json", '[{"id": %d}]' % i)
    moved = []

    def crash(real, when):
        def run(*a, **k):
            if when(*a):
                raise RuntimeError("crash")
            return real(*a, **k)
        return run

    if stop == "before the manifest":
        monkeypatch.setattr(publish, "write_small_text", crash(
            publish.write_small_text, lambda sp, p, t: "staged-" in p))
    elif stop == "before the mark":
        monkeypatch.setattr(publish, "write_small_text", crash(
            publish.write_small_text, lambda sp, p, t: "done-" in p))
    else:
        class OnePool:
            def __init__(self, *_):
                pass

            def __enter__(self):
                return self

            def __exit__(self, *_):
                return False

            def map(self, f, names):
                for n in names:
                    f(n)
                    moved.append(n)
                    if len(moved) == 2:
                        raise RuntimeError("crash")

        monkeypatch.setattr(publish, "ThreadPoolExecutor", OnePool)
    with pytest.raises(Exception, match="crash"):
        flows.ingest(spark, layout, s)
    seen = set(publish.data_files(spark, layout.table_path("bronze.once")))
    monkeypatch.undo()
    flows.ingest(spark, layout, s)
    assert sorted(r.id for r in bronze(spark, layout, "once").collect()) == [0, 1, 2, 3]
    assert seen <= set(publish.data_files(spark, layout.table_path("bronze.once")))
    flows.ingest(spark, layout, s)
    assert bronze(spark, layout, "once").count() == 4


def test_few_files_per_batch_and_partitions(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "parts", "json")
    s = SourceSpec(s.source_name, s.source_path, "json", s.schema_location, partition_by=("day",))
    for i in range(5):
        put(s, f"{i}.json", '[{"id": %d, "day": "d%d", "c%d": 1}]' % (i, i % 2, i))
    q = flows.ingest(spark, layout, s, FlowOptions(max_files_per_trigger=2))
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    df = bronze(spark, layout, "parts")
    assert sorted((r.id, r.day) for r in df.collect()) == [(i, f"d{i % 2}") for i in range(5)]
    assert {f"c{i}" for i in range(5)} <= set(df.columns)
    assert any(f.startswith("day=d1/") for f in
               publish.data_files(spark, layout.table_path("bronze.parts")))
    stamps = df.groupBy("_ingestion_timestamp").agg(F.count(F.lit(1))).count()
    assert stamps == 3                                      # one value per micro-batch


def test_parquet_evolves_by_the_files_of_the_batch(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "typed", "parquet")
    spark.range(3).write.mode("append").parquet(s.source_path)
    flows.ingest(spark, layout, s)
    spark.range(3, 5).withColumn("zone", F.lit("EU")).write.mode("append").parquet(s.source_path)
    for f in os.listdir(s.source_path):
        os.utime(os.path.join(s.source_path, f), (1e9, 1e9))
    flows.ingest(spark, layout, s)
    assert sorted((r.id, r.zone) for r in bronze(spark, layout, "typed").collect()) == [
        (0, None), (1, None), (2, None), (3, "EU"), (4, "EU")]


def test_nothing_landed(spark, run_dir):
    layout = Layout(run_dir)
    s = source(layout, "none", "json")
    with pytest.raises(ValueError, match="no files"):
        flows.ingest(spark, layout, s)
