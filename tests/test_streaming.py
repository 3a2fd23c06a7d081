"""Incremental ingest and silver streams on fresh folders (available-now triggers)."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sources.files import merge_schemas
from stratum.sources.landing import write_csv, write_json_arrays, write_text
from stratum.sources.registry import SourceSpec, load_sources, specs_to_json
from stratum.sources.tables import Layout, read_path
from stratum.streaming import flows
from stratum.streaming.pipeline import KPI_TABLE, Pipeline

TX = ("_seq long, transaction_id string, user_id string, merchant_id string, amount string, "
      "transaction_type string, channel string, status string, currency string, "
      "transaction_date string, reference_id string")


def tx_rows(start, n, amount="10,50"):
    return [(i, f"TXN-20240105-{i:05d}", "USR-000001", "MCH-00001", amount, "pago", "web",
             "aprobado", "PEN", "2024-01-05", None) for i in range(start, start + n)]


def spec(layout, name, fmt):
    return SourceSpec(name, os.path.join(layout.root, "landing", name), fmt,
                      layout.schema_location(name))


def test_registry_skips_inactive(spark, run_dir):
    path = os.path.join(run_dir, "registry.json")
    specs = [SourceSpec("transactions", "/l/t", "json", "/s/t"),
             SourceSpec("users", "/l/u", "text", "/s/u", active=False)]
    spark.createDataFrame([(specs_to_json(specs),)], "value string").coalesce(1) \
        .write.text(path)
    got = load_sources(spark, path)
    assert [s.source_name for s in got] == ["transactions"]
    assert got[0].file_format == "json"


def test_merge_schemas_keeps_old_types_and_appends():
    old = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    new = T.StructType([T.StructField("a", T.StringType()), T.StructField("c", T.DoubleType())])
    merged = merge_schemas(old, new)
    assert [(f.name, f.dataType) for f in merged.fields] == \
        [("a", T.LongType()), ("b", T.StringType()), ("c", T.DoubleType())]


def test_json_ingest_each_file_once_and_lineage(spark, run_dir):
    layout = Layout(run_dir)
    s = spec(layout, "transactions", "json")
    write_json_arrays(spark.createDataFrame(tx_rows(1, 30), TX), s.source_path, rows_per_file=10)
    flows.ingest(spark, layout, s)
    flows.ingest(spark, layout, s)  # nothing new: no duplicates
    b = flows.bronze_table(spark, layout, "transactions")
    assert b.count() == 30
    assert b.filter(F.col("_source_file").isNull()).count() == 0
    assert b.select("_source_file").distinct().count() == 3
    assert dict(b.dtypes)["_seq"] == "bigint"
    assert dict(b.dtypes)["_ingestion_timestamp"] == "timestamp"


def test_schema_evolution_and_rescue(spark, run_dir):
    layout = Layout(run_dir)
    s = spec(layout, "transactions", "json")
    write_json_arrays(spark.createDataFrame(tx_rows(1, 5), TX), s.source_path)
    flows.ingest(spark, layout, s)
    late = spark.createDataFrame(tx_rows(6, 3), TX).withColumn("device", F.lit("ios")) \
        .withColumn("_seq", F.concat(F.lit("x"), F.col("_seq").cast("string")))
    write_json_arrays(late, s.source_path)
    flows.ingest(spark, layout, s)
    b = flows.bronze_table(spark, layout, "transactions")
    assert "device" in b.columns
    rows = {r.transaction_id: r for r in b.collect()}
    assert rows["TXN-20240105-00001"].device is None
    assert rows["TXN-20240105-00006"].device == "ios"
    assert rows["TXN-20240105-00006"]._seq is None
    assert json.loads(rows["TXN-20240105-00006"]._rescued_data) == {"_seq": "x6"}
    assert rows["TXN-20240105-00001"]._rescued_data is None


def test_csv_and_text_ingest(spark, run_dir):
    layout = Layout(run_dir)
    m = spec(layout, "merchants", "csv")
    write_csv(spark.createDataFrame([(1, "MCH-00001", "   ", " Retail"), (2, "MCH-00002", None, "x")],
                                    "_seq int, merchant_id string, merchant_name string, "
                                    "category string"), m.source_path)
    flows.ingest(spark, layout, m)
    rows = {r._seq: r for r in flows.bronze_table(spark, layout, "merchants").collect()}
    assert rows[1].merchant_name == "   " and rows[1].category == " Retail"
    assert rows[2].merchant_name is None
    u = spec(layout, "users", "text")
    write_text(spark.createDataFrame([("a|b",), ("c",)], "value string"), u.source_path)
    flows.ingest(spark, layout, u)
    assert sorted(r.value for r in flows.bronze_table(spark, layout, "users").collect()) == \
        ["a|b", "c"]


def test_stream_dedup_across_restarts_and_fan_in(spark, run_dir):
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    m = spec(layout, "merchants", "csv")
    pipe = Pipeline(spark, layout, [t, m], register_tables=False)
    bad_first = tx_rows(1, 3)
    bad_first[0] = bad_first[0][:4] + ("abc",) + bad_first[0][5:]  # invalid amount
    write_json_arrays(spark.createDataFrame(bad_first, TX), t.source_path)
    write_csv(spark.createDataFrame([(1, "M-1", "x", "retail", "PE", "2023-05-17", "activo", None)],
                                    "_seq int, merchant_id string, merchant_name string, "
                                    "category string, country string, affiliation_date string, "
                                    "status string, risk_level string"), m.source_path)
    pipe.run_bronze()
    pipe.run_silver()
    q = flows.validated(spark, layout, "transactions")  # nothing new: an empty run
    progress = [p for p in q.recentProgress if p.get("observedMetrics")]
    assert all(p["observedMetrics"]["silver_transactions_validated"]["rows"] == 0
               for p in progress)
    # Second delivery: a valid copy of the invalid key, and a new key.
    write_json_arrays(spark.createDataFrame(tx_rows(1, 1) + tx_rows(10, 1), TX), t.source_path)
    pipe.run_bronze()
    pipe.run_silver()
    v = read_path(spark, layout.table_path("silver.transactions_validated"))
    assert v.count() == 4
    reasons = {r.transaction_id: r.rejection_reason for r in v.collect()}
    assert reasons["TXN-20240105-00001"] == "amount es nulo"   # first copy shadows later one
    q = flows.quarantine_table(spark, layout)
    assert sorted((r.source_name, r.rejection_reason) for r in q.collect()) == [
        ("merchants", "formato merchant_id invalido"), ("transactions", "amount es nulo")]
    for r in q.collect():  # the normalised row, with lineage, without ingestion time
        rec = json.loads(r.original_record)
        assert rec["_source_file"].endswith((".txt", ".csv"))
        assert "_ingestion_timestamp" not in rec and rec["rejection_reason"] == r.rejection_reason
    clean = read_path(spark, layout.table_path("silver.transactions"))
    assert clean.count() == 3
    pipe.run_gold()
    k = read_path(spark, layout.table_path(KPI_TABLE))
    assert k.agg(F.sum("total_transactions")).collect()[0][0] == 3


def kpi_equals_recompute(spark, layout, pipe):
    from stratum.plans import gold
    full = gold.daily_kpis(pipe._read_silver("transactions"), with_timestamp=False)
    got = read_path(spark, layout.table_path(KPI_TABLE)).drop("_processed_at").select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    return got.agg(F.sum("total_transactions")).first()[0]


def test_full_refresh_reaches_all_that_is_derived(spark, run_dir):
    layout = Layout(run_dir)
    t, u = spec(layout, "transactions", "json"), spec(layout, "users", "text")
    pipe = Pipeline(spark, layout, [t, u], register_tables=False)
    bad = [r[:4] + ("abc",) + r[5:] for r in tx_rows(50, 2)]
    write_json_arrays(spark.createDataFrame(tx_rows(1, 4) + bad, TX), t.source_path)
    write_text(spark.createDataFrame([("a|b",), ("c",)], "value string"), u.source_path)
    pipe.run()
    for table in ("silver.transactions_validated", "bronze.transactions", "silver.quarantine",
                  "silver.users_validated", "gold.daily_transaction_kpis"):
        pipe.full_refresh(table)
        pipe.run()
        assert read_path(spark, layout.table_path("silver.transactions")).count() == 4
        assert flows.quarantine_table(spark, layout).count() == 2
        assert kpi_equals_recompute(spark, layout, pipe) == 4
        assert read_path(spark, layout.table_path("silver.users_structure_quarantine")).count() == 2


def test_kpi_refresh_stopped_before_the_pointer_moves(spark, run_dir, monkeypatch):
    from stratum.streaming import pipeline as pl
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=False)

    def deliver(start, n):
        write_json_arrays(spark.createDataFrame(tx_rows(start, n), TX), t.source_path)
        pipe.run_bronze(); pipe.run_silver()

    def crash(*_):
        raise RuntimeError("crash")

    deliver(1, 3)
    pipe.run_gold()
    deliver(10, 2)
    monkeypatch.setattr(pl, "write_versioned", crash)    # after the KPI overwrite
    try:
        pipe.run_gold()
        raise AssertionError("no crash")
    except RuntimeError:
        pass
    monkeypatch.undo()
    deliver(20, 1)                                       # the same date, before the repair
    pipe.run_gold()
    assert kpi_equals_recompute(spark, layout, pipe) == 6
    pipe.run_gold(incremental=False)
    assert kpi_equals_recompute(spark, layout, pipe) == 6


def test_kpi_refresh_stopped_inside_a_batch_and_folding(spark, run_dir, monkeypatch):
    from stratum.plans import gold
    from stratum.streaming import pipeline as pl
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=False)
    monkeypatch.setattr(pl, "FOLD_AFTER", 1)
    real = gold.kpi_partials

    def written_then_crash(batch):
        path = f"{layout.checkpoint('gold_daily_transaction_kpis')}/partials"
        real(batch).write.mode("overwrite").partitionBy("transaction_date").parquet(
            f"{path}/run=batch-{len(seen):09d}")
        raise RuntimeError("crash")

    seen = []
    for start in (1, 10, 20, 30):
        write_json_arrays(spark.createDataFrame(tx_rows(start, 2), TX), t.source_path)
        pipe.run_bronze(); pipe.run_silver()
        monkeypatch.setattr(gold, "kpi_partials", written_then_crash)
        try:
            pipe.run_gold()
            raise AssertionError("no crash")
        except AssertionError:
            raise
        except Exception:
            pass
        monkeypatch.setattr(gold, "kpi_partials", real)
        pipe.run_gold()
        seen.append(start)
        assert kpi_equals_recompute(spark, layout, pipe) == 2 * len(seen)


def test_quarantine_accepts_a_source_added_later(spark, run_dir):
    layout = Layout(run_dir)
    t, m = spec(layout, "transactions", "json"), spec(layout, "merchants", "csv")
    write_json_arrays(spark.createDataFrame(
        [r[:4] + ("abc",) + r[5:] for r in tx_rows(1, 2)], TX), t.source_path)
    first = Pipeline(spark, layout, [t], register_tables=False)
    first.run_bronze(); first.run_silver()
    write_csv(spark.createDataFrame([(1, "M-1", "x")], "_seq int, merchant_id string, "
                                    "category string"), m.source_path)
    both = Pipeline(spark, layout, [t, m], register_tables=False)
    both.run_bronze(); both.run_silver()
    assert sorted(r.source_name for r in flows.quarantine_table(spark, layout).collect()) == \
        ["merchants", "transactions", "transactions"]


def test_catalog_registration(spark, run_dir):
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=True)
    write_json_arrays(spark.createDataFrame(tx_rows(1, 4), TX), t.source_path)
    pipe.run()
    assert spark.read.table("silver.transactions").count() == 4
    assert spark.read.table("gold.daily_transaction_kpis").count() == 1
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gold.fraud_detection_alerts")
             .collect()}
    assert props.get("quality") == "gold"
    assert spark.read.table("silver.quarantine").count() == 0
    assert [r.partition for r in spark.sql("SHOW PARTITIONS gold.daily_transaction_kpis")
            .collect()] == ["transaction_date=2024-01-05"]
    # A wider delivery widens the registered tables in place.
    late = spark.createDataFrame(tx_rows(10, 2), TX).withColumn("device", F.lit("ios"))
    write_json_arrays(late, t.source_path)
    pipe.run()
    assert {r.device for r in spark.read.table("silver.transactions").collect()} == {None, "ios"}


def test_clean_sink_files_follow_tasks_not_dates(spark, run_dir):
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    rows = [r[:1] + (f"TXN-202401{1 + i % 28:02d}-{i:05d}",) + r[2:9]
            + (f"2024-01-{1 + i % 28:02d}",) + r[10:] for i, r in enumerate(tx_rows(0, 560))]
    write_json_arrays(spark.createDataFrame(rows, TX), t.source_path)
    pipe = Pipeline(spark, layout, [t], register_tables=False)
    pipe.run_bronze(); pipe.run_silver(); pipe.run_gold()
    clean = pipe._read_silver("transactions")
    assert clean.count() == 560
    assert len(clean.inputFiles()) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert kpi_equals_recompute(spark, layout, pipe) == 560


def test_csv_header_groups(spark, run_dir):
    import pytest
    layout = Layout(run_dir)
    m = spec(layout, "merchants", "csv")
    cols = "_seq int, merchant_id string, category string"
    write_csv(spark.createDataFrame([(1, "MCH-00001", "retail")], cols), m.source_path)
    flows.ingest(spark, layout, m)
    # A later file with an extra trailing column: positional reading is exact.
    write_csv(spark.createDataFrame([(2, "MCH-00002", "moda", "PE")], cols + ", country string"),
              m.source_path)
    flows.ingest(spark, layout, m)
    rows = {r._seq: r for r in flows.bronze_table(spark, layout, "merchants").collect()}
    assert rows[1].country is None and rows[2].country == "PE" and rows[2].category == "moda"
    # A file with the columns in another order is read by name.
    write_csv(spark.createDataFrame([("MCH-00003", 3, "salud")],
                                    "merchant_id string, _seq int, category string"), m.source_path)
    flows.ingest(spark, layout, m)
    rows = {r._seq: r for r in flows.bronze_table(spark, layout, "merchants").collect()}
    assert rows[3].merchant_id == "MCH-00003" and rows[3].category == "salud"
    assert rows[3]._rescued_data is None


def test_salted_stream_dedup_hot_null_key(spark, run_dir):
    from stratum.operators.dedup import dedup_stream
    src = os.path.join(run_dir, "src")
    cols = "k string, seq long, v string"
    rows = [(None, i, f"v{i % 50}") for i in range(400)] + [("a", 1000, "x"), ("a", 1001, "y")]
    spark.createDataFrame(rows, cols).write.parquet(src)
    schema = spark.read.parquet(src).schema

    def run():
        out = dedup_stream(spark.readStream.schema(schema).parquet(src), ["k"], salt_buckets=8)
        (out.writeStream.format("parquet").option("path", os.path.join(run_dir, "out"))
         .option("checkpointLocation", os.path.join(run_dir, "ck"))
         .trigger(availableNow=True).start().awaitTermination())
        return out

    out = run()
    spark.createDataFrame([(None, 5000, "late"), ("a", 5001, "late"), ("b", 5002, "new")], cols) \
        .write.mode("append").parquet(src)
    run()
    got = spark.read.parquet(os.path.join(run_dir, "out")).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r.k, []).append(r)
    assert sorted(by_key, key=str) == sorted([None, "a", "b"], key=str)
    assert all(len(v) == 1 for v in by_key.values())
    assert by_key[None][0].v != "late" and by_key["a"][0].v != "late"
    plan = out._jdf.queryExecution().logical().toString()
    assert plan.count("Deduplicate") == 2   # one for all keys, one that thins hot ones first


def test_incremental_kpi_refresh_equals_full_rebuild(spark, run_dir):
    from stratum.plans import gold
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=False)

    def rows(start, n, date, kind="pago", amount="10,50"):
        return [(i, f"TXN-{date.replace('-', '')}-{i:05d}", "USR-000001", "MCH-00001", amount,
                 kind, "web", "aprobado", "PEN", date, None) for i in range(start, start + n)]

    write_json_arrays(spark.createDataFrame(rows(1, 5, "2024-01-05") + rows(10, 3, "2024-01-06"),
                                            TX), t.source_path)
    pipe.run_bronze(); pipe.run_silver(); pipe.run_gold()
    kpi = layout.table_path(KPI_TABLE)
    untouched = sorted(f for f in spark.read.parquet(kpi).inputFiles() if "2024-01-05" in f)
    # Second delivery touches 2024-01-06 and a new date only.
    second = rows(20, 2, "2024-01-06", "retiro", "5.25") + rows(30, 1, "2024-01-07")
    write_json_arrays(spark.createDataFrame(second, TX), t.source_path)
    pipe.run_bronze(); pipe.run_silver(); pipe.run_gold()
    after = sorted(f for f in spark.read.parquet(kpi).inputFiles() if "2024-01-05" in f)
    assert after == untouched  # partition not rewritten
    full = gold.daily_kpis(read_path(spark, layout.table_path("silver.transactions")),
                           with_timestamp=False)
    got = spark.read.parquet(kpi).drop("_processed_at").select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert got.count() == 3


def test_continuous_trigger_pipeline(spark, run_dir):
    from stratum.streaming.flows import FlowOptions
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    write_json_arrays(spark.createDataFrame(tx_rows(1, 3), TX), t.source_path)
    pipe = Pipeline(spark, layout, [t], opts=FlowOptions(processing_time="1 second"),
                    register_tables=False)
    try:
        pipe.run_bronze()
        pipe.run_silver()
        assert all(q.isActive for q in pipe.queries) and len(pipe.queries) == 4
        # New files while the flows run: picked up without a restart.
        write_json_arrays(spark.createDataFrame(tx_rows(1, 1) + tx_rows(50, 2), TX),
                          t.source_path)
        import time
        time.sleep(2)
        pipe.catch_up()
        pipe.catch_up()
    finally:
        pipe.stop()
    clean = read_path(spark, layout.table_path("silver.transactions"))
    assert sorted(r._seq for r in clean.collect()) == [1, 2, 3, 50, 51]


def test_schema_evolution_flows_through_silver(spark, run_dir):
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=False)
    write_json_arrays(spark.createDataFrame(tx_rows(1, 2), TX), t.source_path)
    pipe.run_bronze(); pipe.run_silver()
    late = spark.createDataFrame(tx_rows(10, 2), TX).withColumn("device", F.lit("ios"))
    write_json_arrays(late, t.source_path)
    pipe.run_bronze(); pipe.run_silver(); pipe.run_gold()
    clean = pipe._read_silver("transactions")
    rows = {r._seq: r.device for r in clean.collect()}
    assert rows == {1: None, 2: None, 10: "ios", 11: "ios"}
    assert read_path(spark, layout.table_path(KPI_TABLE)).count() == 1


def test_schema_versions_survive_a_crash_between_write_and_rename(spark, run_dir):
    from stratum.sources import files
    where = os.path.join(run_dir, "schema")
    old = T.StructType([T.StructField("a", T.LongType())])
    files.save_schema(spark, where, old, 5)
    with open(os.path.join(where, "v000000002.json.tmp"), "w") as f:
        f.write('{"schema": {"ty')                       # written, not renamed
    assert files.load_schema(spark, where) == old
    with open(os.path.join(where, "v000000002.json"), "w") as f:
        f.write('{"schema": {"ty')                       # a file system without atomic rename
    assert files.load_schema(spark, where) == old
    wide = T.StructType([*old.fields, T.StructField("b", T.StringType())])
    for _ in range(5):
        files.save_schema(spark, where, wide, 6)
    assert files.load_schema(spark, where) == wide
    assert len(files._versions(spark, where)) <= files.VERSIONS_KEPT


def test_rescue_keeps_nested_surplus_and_unparseable(spark, run_dir):
    layout = Layout(run_dir)
    s = spec(layout, "devices", "json")
    os.makedirs(s.source_path)

    def put(name, text, folder=None):
        with open(os.path.join(folder or s.source_path, name), "w") as f:
            f.write(text)

    put("a.json", '[{"k": 1, "s": {"x": 1}, "l": [1, 2]}, {"k": 2, "s": {"x": 2}, "l": []}]')
    flows.ingest(spark, layout, s)
    put("b.json", '[{"k": 3, "s": {"x": "bad"}}, {"k": 4, "s": "text"}, {"k": 5, "s": null}]')
    put("c.json", '[{"k": 6, "s": {"x": 6}}, {"k": 7, "s"')
    flows.ingest(spark, layout, s)
    rows = flows.bronze_table(spark, layout, "devices").collect()
    by = {r.k: r for r in rows if r.k is not None}
    assert by[1].s.x == 1 and by[1].l == [1, 2] and by[1]._rescued_data is None
    assert json.loads(by[3]._rescued_data) == {"s": '{"x":"bad"}'}
    assert json.loads(by[4]._rescued_data) == {"s": '"text"'}
    assert by[5]._rescued_data is None
    broken = [r._rescued_data for r in rows if r._source_file == "c.json" and r._rescued_data]
    assert broken and '"k": 7' in json.loads(broken[0])["_corrupt_record"]

    c = spec(layout, "plain", "csv")
    os.makedirs(c.source_path)
    put("a b.csv", "k,v\n1,a\n2,b,EXTRA\n3\n", c.source_path)     # a blank in the name
    flows.ingest(spark, layout, c)
    got = {r.k: r for r in flows.bronze_table(spark, layout, "plain").collect()}
    assert json.loads(got[2]._rescued_data) == {"_surplus_values": "2,b,EXTRA"}
    assert got[1]._rescued_data is None and got[3]._rescued_data is None and got[3].v is None


def test_contract_columns_stay_text(spark, run_dir):
    layout = Layout(run_dir)
    m = spec(layout, "merchants", "csv")
    cols = ("_seq int, merchant_id string, merchant_name string, category string, "
            "country string, affiliation_date string, status string, risk_level string")

    def deliver(i, date):
        write_csv(spark.createDataFrame([(i, f"MCH-0000{i}", "n", "retail", "PE", date, "activo",
                                          "bajo")], cols), m.source_path)

    pipe = Pipeline(spark, layout, [m], register_tables=False)
    deliver(1, "2023-05-17")                 # ISO only at first
    pipe.run_bronze(); pipe.run_silver()
    deliver(2, "17/05/2023")
    pipe.run_bronze(); pipe.run_silver()
    v = read_path(spark, layout.table_path("silver.merchants_validated"))
    assert {str(r.affiliation_date) for r in v.collect()} == {"2023-05-17"}
    assert "affiliation_date invalida" not in {r.rejection_reason for r in v.collect()}
    assert dict(flows.bronze_table(spark, layout, "merchants").dtypes)["affiliation_date"] == "string"
    # Amounts as well: a number first, a comma later.
    t = spec(layout, "transactions", "json")
    os.makedirs(t.source_path)
    for i, amount in ((1, "10.50"), (2, '"10,50"')):
        with open(os.path.join(t.source_path, f"{i}.json"), "w") as f:
            f.write('[{"_seq": %d, "amount": %s}]' % (i, amount))
        flows.ingest(spark, layout, t)
    got = {r._seq: r.amount for r in flows.bronze_table(spark, layout, "transactions").collect()}
    assert got[2] == "10,50" and float(got[1]) == 10.5


def test_continuous_csv_is_read_by_name(spark, run_dir):
    import time
    layout = Layout(run_dir)
    m = spec(layout, "merchants", "csv")
    write_csv(spark.createDataFrame([(1, "MCH-00001")], "_seq int, merchant_id string"),
              m.source_path)
    q = flows.ingest(spark, layout, m, flows.FlowOptions(processing_time="1 second"))
    try:
        write_csv(spark.createDataFrame([("MCH-00002", 2, "PE")],
                                        "merchant_id string, _seq int, country string"),
                  m.source_path)
        time.sleep(1)
        q.processAllAvailable()
    finally:
        q.stop()
    rows = {r._seq: r for r in flows.bronze_table(spark, layout, "merchants").collect()}
    assert rows[1].merchant_id == "MCH-00001" and rows[1].country is None
    assert rows[2].merchant_id == "MCH-00002" and rows[2].country == "PE"


def test_checkpoint_folder_is_shared_storage(spark):
    import pytest
    from stratum import session

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Fake:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})
            getCheckpointDir = staticmethod(lambda: None)
            setCheckpointDir = staticmethod(lambda d: None)
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Fake)
    assert session.ensure_checkpoint_dir(Fake, "s3a://lake/pay/") == "s3a://lake/pay/_checkpoints"
    assert Fake.conf["spark.checkpoint.dir"] == "s3a://lake/pay/_checkpoints"
