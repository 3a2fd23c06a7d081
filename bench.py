"""Benchmark the headline pipeline stages.

Setup (not timed): the dirty fixtures derived from ``$BENCH_SF_DIR`` are
stored once as bronze Parquet tables (and as JSON landing files for the
stream stage) in a fresh folder under ``spark.checkpoint.dir``, the way the
pipeline finds its inputs in production.  Each stage is then timed over those
stored inputs: one warm-up run, then the median of ``$BENCH_RUNS`` (default 5)
runs, each result fully consumed by the ``noop`` sink.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stratum.plans import gold, merchants, transactions  # noqa: E402
from stratum.session import build_session, shared_path  # noqa: E402
from stratum.sources import fixtures  # noqa: E402
from stratum.sources.landing import write_json_arrays  # noqa: E402
from stratum.sources.registry import SourceSpec  # noqa: E402
from stratum.sources.tables import Layout  # noqa: E402
from stratum.streaming import flows  # noqa: E402
from stratum.streaming.pipeline import Pipeline  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="bench")
    root = shared_path(spark, "bench", fresh=True)
    p = lambda *parts: os.path.join(root, *parts)

    # ---- setup: stored bronze inputs --------------------------------------------------------
    fixtures.raw_transactions(spark, sf_dir).write.parquet(p("bronze", "transactions"))
    fixtures.raw_merchants(spark, sf_dir).write.parquet(p("bronze", "merchants"))
    fixtures.raw_users(spark, sf_dir).write.parquet(p("bronze", "users"))
    rd = lambda *parts: spark.read.parquet(p(*parts))
    tx_valid = transactions.validate(rd("bronze", "transactions"))
    tx_valid.write.parquet(p("silver", "transactions_validated"))
    transactions.clean(rd("silver", "transactions_validated")).write.parquet(
        p("silver", "transactions"))
    m_valid = merchants.validate(rd("bronze", "merchants"))
    merchants.clean(m_valid).write.parquet(p("silver", "merchants"))
    gold.daily_kpis(rd("silver", "transactions")).write.partitionBy("transaction_date") \
        .parquet(p("gold", "daily_transaction_kpis"))
    landing = p("landing", "transactions")
    write_json_arrays(fixtures.raw_transactions(spark, sf_dir), landing, rows_per_file=20_000)

    kpi_cols = gold.daily_kpis(rd("silver", "transactions")).columns

    def kpis_table():
        return rd("gold", "daily_transaction_kpis").select(*kpi_cols)

    # ---- stages ------------------------------------------------------------------------------
    def q_tx_validate():
        consume(transactions.validate(rd("bronze", "transactions")))

    def q_tx_split():
        v = rd("silver", "transactions_validated")
        consume(transactions.clean(v))
        consume(transactions.quarantine(v))

    def q_daily_kpis():
        consume(gold.daily_kpis(rd("silver", "transactions")))

    def q_merchant_summary():
        consume(gold.merchant_risk_summary(kpis_table(), rd("silver", "merchants")))

    def q_fraud_alerts():
        consume(gold.fraud_alerts(kpis_table()))

    def q_merchants_validate():
        consume(merchants.validate(rd("bronze", "merchants")))

    raw_users = fixtures.raw_users(spark, sf_dir).withColumn("_source_file", F.lit("users.txt"))
    stored_users = p("users_bronze")
    raw_users.write.parquet(stored_users)

    def stream_chain(i: int) -> dict[str, float]:
        """One fresh pipeline: landing files -> validated -> clean + quarantine -> gold, and
        stored users lines -> users tables; seconds per part."""
        layout = Layout(p("stream", f"run{i}"))
        spec = SourceSpec("transactions", landing, "json",
                          layout.schema_location("transactions"))
        pipe = Pipeline(spark, layout, [spec], register_tables=False)
        rd("users_bronze").write.parquet(layout.table_path("bronze.users"))
        schema = lambda: pipe._bronze_schema("transactions")
        parts = {
            "stream_ingest_to_validated": lambda: (
                flows.ingest(spark, layout, spec), flows.validated(spark, layout, "transactions")),
            "stream_clean_and_quarantine": lambda: (
                flows.clean(spark, layout, "transactions", bronze_schema=schema()),
                flows.quarantine(spark, layout, "transactions", declare=False,
                                 bronze_schema=schema())),
            "stream_gold_refresh": pipe.run_gold,
            "users_split_flags_summary": lambda: consume(pipe.run_users()),
        }
        out = {}
        for name, fn in parts.items():
            t0 = time.perf_counter()
            fn()
            out[name] = time.perf_counter() - t0
        return out

    stages = {
        "tx_normalize_dedup_validate": q_tx_validate,
        "tx_clean_and_quarantine": q_tx_split,
        "merchants_validate": q_merchants_validate,
        "gold_daily_kpis": q_daily_kpis,
        "gold_merchant_risk_summary": q_merchant_summary,
        "gold_fraud_alerts": q_fraud_alerts,
    }
    results = {name: timed(fn, runs) for name, fn in stages.items()}
    chains = [stream_chain(i) for i in range(runs + 1)][1:]  # the first one warms up
    results |= {name: round(statistics.median(c[name] for c in chains), 4) for name in chains[0]}
    out = {
        "metric": "pipeline_stage_median_sum",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
