"""End-to-end run through the command-line entry point (registry -> all layers)."""

import os

from pyspark.sql import functions as F

from stratum import run
from stratum.sources.registry import specs_to_json
from stratum.sources.tables import Layout, read_path
from stratum.streaming import flows, staging
from stratum.streaming.pipeline import ALERTS_TABLE, KPI_TABLE, SUMMARY_TABLE, USERS_TABLE

from conftest import SF_SMALL


def test_cli_runs_every_layer(spark, run_dir):
    layout = Layout(run_dir)
    specs = []
    for source, fmt in staging.DEFAULT_FORMATS.items():
        raw = staging.FIXTURE_READERS[source](spark, SF_SMALL)
        specs.append(staging.stage(spark, layout, source, raw, fmt))
    registry = os.path.join(run_dir, "registry.json")
    spark.createDataFrame([(specs_to_json(specs),)], "value string").coalesce(1) \
        .write.text(registry)
    assert run.main(["--registry", registry, "--root", run_dir, "--no-catalog"]) == 0

    clean = read_path(spark, layout.table_path("silver.transactions"))
    kpis = read_path(spark, layout.table_path(KPI_TABLE))
    assert kpis.agg(F.sum("total_transactions")).collect()[0][0] == clean.count() > 0
    assert read_path(spark, layout.table_path(ALERTS_TABLE)).filter(
        "alert_reason IS NULL OR alert_reason = ''").count() == 0
    assert read_path(spark, layout.table_path(SUMMARY_TABLE)).count() == \
        read_path(spark, layout.table_path("silver.merchants")).count()
    assert read_path(spark, layout.table_path(USERS_TABLE)).count() == 117
    q = flows.quarantine_table(spark, layout)
    assert {r.source_name for r in q.select("source_name").distinct().collect()} == \
        {"transactions"}  # ten suppliers at sf0.001 break no merchant rule
