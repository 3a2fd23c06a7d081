"""Hot dedup keys, bounded dedup state, pruned KPI partials, own marks, enforced targets."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.dedup import dedup_stream, hot_keys
from stratum.operators.quality import QUARANTINE_SCHEMA
from stratum.plans import gold, transactions
from stratum.sources.landing import write_json_arrays
from stratum.sources.tables import Layout, declare_table, read_path, require_schema
from stratum.streaming import flows
from stratum.streaming.flows import FlowOptions
from stratum.streaming.pipeline import KPI_TABLE, Pipeline, read_partials

from test_streaming import TX, kpi_equals_recompute, spec, tx_rows


def test_sketch_finds_the_hot_keys_only(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "N/A").when(
        F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))).alias("k"))
    want = df.where("k = 'N/A'").select(F.xxhash64("k")).first()[0]
    found = hot_keys(df, ["k"], 8)
    null = df.where("k IS NULL").select(F.xxhash64("k")).first()[0]
    assert want in found and set(found) <= {want, null}
    assert hot_keys(df.limit(0), ["k"], 8) == []


def run_stream(df, run_dir):
    (df.writeStream.format("parquet").option("path", os.path.join(run_dir, "out"))
     .option("checkpointLocation", os.path.join(run_dir, "ck"))
     .trigger(availableNow=True).start().awaitTermination())


def test_hot_key_spreads_over_all_partitions(spark, run_dir):
    src = os.path.join(run_dir, "src")
    rows = spark.range(24000).select(
        F.when(F.col("id") % 3 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
        .alias("k"), "id", F.current_timestamp().alias("_ingestion_timestamp"))
    rows.repartition(6).write.parquet(src)
    batch = spark.read.parquet(src)
    hot = hot_keys(batch, ["k"], 8)
    out = dedup_stream(spark.readStream.schema(batch.schema).parquet(src), ["k"], 8, hot=hot)
    run_stream(out, run_dir)
    got = [r.k for r in spark.read.parquet(os.path.join(run_dir, "out")).collect()]
    assert sorted(got) == sorted(r.k for r in batch.select("k").distinct().collect())
    # Where the copies of the hot key were compared: the state of the thinning step.
    store = spark.read.format("state-metadata").load(os.path.join(run_dir, "ck"))
    thinning = None
    for r in store.select("operatorId").distinct().collect():
        state = (spark.read.format("statestore").option("operatorId", r.operatorId)
                 .load(os.path.join(run_dir, "ck")))
        if "_dedup_salt" in state.select("key.*").columns:
            thinning = state
    per = thinning.where("key.k = 'N/A'").groupBy("partition_id").count().collect()
    assert len(per) >= 4 and sum(r["count"] for r in per) == 8
    # A list that changes between restarts changes the path of rows only.
    again = dedup_stream(spark.readStream.schema(batch.schema).parquet(src), ["k"], 8, hot=())
    rows.limit(3000).union(rows.where("false")).write.mode("append").parquet(src)
    run_stream(again, run_dir)
    assert spark.read.parquet(os.path.join(run_dir, "out")).count() == len(got)


def test_flow_finds_hot_keys_in_new_bronze_files(spark, run_dir):
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=False)
    rows = [r[:1] + ("N/A",) + r[2:] for r in tx_rows(1, 1500)] + tx_rows(5000, 1500)
    write_json_arrays(spark.createDataFrame(rows, TX), t.source_path)
    pipe.run_bronze()
    schema = pipe._bronze_schema("transactions")
    found = flows.known_hot_keys(spark, layout, "transactions", FlowOptions(), schema)
    assert found == [spark.sql("SELECT xxhash64('N/A')").first()[0]]
    assert flows.known_hot_keys(spark, layout, "transactions", FlowOptions(), schema) == found
    pipe.run_silver()
    v = read_path(spark, layout.table_path("silver.transactions_validated"))
    assert v.count() == 1501


@pytest.mark.parametrize("salt", [None, 4])
def test_bounded_state_by_watermark(spark, run_dir, salt):
    src = os.path.join(run_dir, "src")
    schema = "k string, v string, at timestamp"

    def deliver(rows):
        spark.createDataFrame(rows, "k string, v string, at string").withColumn(
            "at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
        out = dedup_stream(spark.readStream.schema(schema).parquet(src), ["k"], salt,
                           ("at",), within="1 day", time_col="at")
        run_stream(out, run_dir)
        return sorted(r.v for r in spark.read.parquet(os.path.join(run_dir, "out")).collect())

    assert deliver([("a", "a1", "2024-01-01"), (None, "n1", "2024-01-01")]) == ["a1", "n1"]
    # A copy within the bound goes.
    assert deliver([("a", "a2", "2024-01-01 12:00:00"), ("b", "b1", "2024-01-01 12:00:00")]) == [
        "a1", "b1", "n1"]
    deliver([("c", "c1", "2024-01-09")])                  # the watermark moves on
    # A copy beyond the bound passes as new; its state was dropped.
    assert deliver([("a", "a3", "2024-01-09"), (None, "n2", "2024-01-09")]) == [
        "a1", "a3", "b1", "c1", "n1", "n2"]


def test_bounded_state_is_an_option_of_the_flow(spark, run_dir):
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], FlowOptions(dedup_within="7 days"), register_tables=False)
    for rows in (tx_rows(1, 5), tx_rows(1, 2) + tx_rows(20, 1)):
        write_json_arrays(spark.createDataFrame(rows, TX), t.source_path)
        pipe.run_bronze()
        pipe.run_silver()
    assert read_path(spark, layout.table_path("silver.transactions_validated")).count() == 6
    plan = flows.validated_plan(spark, layout, "transactions", pipe.opts,
                                pipe._bronze_schema("transactions"))
    text = plan._jdf.queryExecution().logical().toString()
    assert "EventTimeWatermark" in text and "DeduplicateWithinWatermark" in text


def deliver(spark, t, pipe, rows):
    write_json_arrays(spark.createDataFrame(rows, TX), t.source_path)
    pipe.run_bronze()
    pipe.run_silver()
    pipe.run_gold()


def on(date, start, n):
    return [r[:1] + (f"TXN-{date.replace('-', '')}-{r[0]:05d}",) + r[2:9] + (date,) + r[10:]
            for r in tx_rows(start, n)]


def test_refresh_reads_the_partials_of_touched_dates_only(spark, run_dir):
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=False)
    deliver(spark, t, pipe, on("2024-01-05", 1, 3) + on("2024-01-06", 10, 2))
    deliver(spark, t, pipe, on("2024-01-06", 20, 4))
    folder = f"{layout.checkpoint('gold_daily_transaction_kpis')}/partials"
    paths = [f"{folder}/run=batch-{i:09d}" for i in range(2)]
    shape = T.StructType([f for f in read_path(spark, layout.table_path(KPI_TABLE)).schema.fields
                          if f.name in (*gold.KPI_KEYS, *gold.ADDITIVE_KPIS)])
    every = read_partials(spark, folder, paths, shape)
    day = every.filter(F.col("transaction_date").isin(
        [r[0] for r in spark.sql("SELECT DATE '2024-01-05'").collect()]))
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "transaction_date" in filters and "2024-01-05" in plan
    assert day.count() == 1
    assert kpi_equals_recompute(spark, layout, pipe) == 9


def test_kpis_without_success_markers(spark, run_dir):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        layout = Layout(run_dir)
        t = spec(layout, "transactions", "json")
        pipe = Pipeline(spark, layout, [t], register_tables=False)
        deliver(spark, t, pipe, on("2024-01-05", 1, 3))
        assert kpi_equals_recompute(spark, layout, pipe) == 3
        deliver(spark, t, pipe, on("2024-01-05", 10, 2))
        assert kpi_equals_recompute(spark, layout, pipe) == 5
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_a_flow_must_fit_its_declared_target(spark, run_dir, monkeypatch):
    require_schema("t", "a long, B string", T._parse_datatype_string("b string, a long"))
    for bad, text in (("a long, b string, c int", "c is not declared"), ("a long", "B is missing"),
                      ("a int, b string", "a is int, declared bigint")):
        with pytest.raises(ValueError, match=text):
            require_schema("t", "a long, B string", T._parse_datatype_string(bad))
    layout = Layout(run_dir)
    t = spec(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [t], register_tables=False)
    write_json_arrays(spark.createDataFrame(tx_rows(1, 2), TX), t.source_path)
    pipe.run_bronze()
    pipe.run_silver()
    real = transactions.quarantine
    for change, text in ((lambda q: q.withColumn("note", F.lit("x")), "note is not declared"),
                         (lambda q: q.withColumn("rejection_reason", F.lit(1)), "is int, declared"),
                         (lambda q: q.drop("source_name"), "source_name is missing")):
        monkeypatch.setattr(transactions, "quarantine", lambda v: change(real(v)))
        with pytest.raises(ValueError, match=text):
            pipe.run_silver()
    monkeypatch.undo()
    pipe.run_silver()


def test_a_declared_table_keeps_its_schema(spark, run_dir):
    layout = Layout(run_dir)
    spark.sql("CREATE SCHEMA IF NOT EXISTS silver")
    name = f"silver.declared_{int(time.time())}"
    declare_table(spark, layout, name, QUARANTINE_SCHEMA)
    declare_table(spark, layout, name, QUARANTINE_SCHEMA)
    try:
        with pytest.raises(ValueError, match="extra"):
            declare_table(spark, layout, name, "a long, extra int")
    finally:
        spark.sql(f"DROP TABLE {name}")
