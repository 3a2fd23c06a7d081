"""Physical-plan properties the design relies on at scale (checked on stored inputs)."""

import re

import pytest
from pyspark.sql import functions as F

from stratum.plans import gold, merchants, transactions, users
from stratum.sources import fixtures

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    from stratum.session import shared_path
    root = shared_path(spark, "tests", "plans", fresh=True)
    fixtures.raw_transactions(spark, SF_SMALL).write.parquet(f"{root}/tx")
    fixtures.raw_merchants(spark, SF_SMALL).write.parquet(f"{root}/m")
    fixtures.raw_users(spark, SF_SMALL).write.parquet(f"{root}/u")
    clean = transactions.clean(transactions.validate(spark.read.parquet(f"{root}/tx")))
    clean.write.parquet(f"{root}/clean")
    k = gold.daily_kpis(spark.read.parquet(f"{root}/clean"))
    k.write.partitionBy("transaction_date").parquet(f"{root}/kpi")
    return root


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_validate_one_exchange_with_partial_dedup(spark, stored):
    plan = executed(transactions.validate(spark.read.parquet(f"{stored}/tx")))
    assert plan.count("Exchange hashpartitioning(transaction_id") == 1
    assert "partial_min_by" in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_kpis_partial_aggregate_single_exchange_pruned_scan(spark, stored):
    df = gold.daily_kpis(spark.read.parquet(f"{stored}/clean"))
    plan = executed(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "partial_sum" in plan
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    read = {c.split("#")[0] for c in scanned.split(",")}
    assert read == {"transaction_date", "merchant_id", "channel", "currency",
                    "transaction_type", "status", "amount"}


def test_summary_distinct_is_preaggregated_and_join_not_forced(spark, stored):
    kpis = spark.read.parquet(f"{stored}/kpi")
    m = merchants.clean(merchants.validate(spark.read.parquet(f"{stored}/m")))
    df = gold.merchant_risk_summary(kpis, m)
    logical = df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in logical.lower()  # no hint: size-based choice by Spark/AQE
    plan = executed(df)
    assert "LeftOuter" in plan
    assert "Exchange hashpartitioning(merchant_id#" in plan
    assert re.search(r"hashpartitioning\(merchant_id#\d+, transaction_date#\d+", plan)


def test_users_chain_is_narrow(spark, stored):
    raw = spark.read.parquet(f"{stored}/u")
    flagged = users.validated(raw, keep=("_seq",))
    plan = executed(flagged)
    assert "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_kpi_date_filter_prunes_partitions(spark, stored):
    df = spark.read.parquet(f"{stored}/kpi").filter(F.col("transaction_date") == F.lit("2024-01-01")
                                                    .cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*transaction_date", plan)
