"""Gold indicators on hand-built inputs, dedup behaviour and plan shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators.dedup import dedup_first
from stratum.plans import gold

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
TX = ("transaction_date date, merchant_id string, channel string, currency string, "
      "transaction_type string, status string, amount double")


def kpis_of(spark, rows):
    return {(r.transaction_date, r.merchant_id, r.channel, r.currency): r
            for r in gold.daily_kpis(spark.createDataFrame(rows, TX)).collect()}


def test_kpis_counts_sums_rate_score(spark):
    rows = [
        (D1, "MCH-00001", "web", "PEN", "pago", "aprobado", 100.0),
        (D1, "MCH-00001", "web", "PEN", "pago", "rechazado", 50.0),
        (D1, "MCH-00001", "web", "PEN", "reversa", "aprobado", 60000.0),
        (D1, "MCH-00001", "web", "PEN", "retiro", "pendiente", 10.0),
        (D1, "MCH-00001", "web", "PEN", None, "aprobado", 5.0),
    ]
    k = kpis_of(spark, rows)[(D1, "MCH-00001", "web", "PEN")]
    assert (k.total_transactions, k.total_payments, k.total_reversals, k.total_withdrawals) == \
        (5, 2, 1, 1)
    assert k.total_rejected_transactions == 1
    assert k.total_amount == 60165.0 and k.average_amount == 60165.0 / 5
    assert k.reversed_amount == 60000.0
    assert k.reversal_rate == 0.5
    assert k.risk_score == 0.5 * 60 + 40


def test_rate_zero_without_payments_and_score_cap(spark):
    rows = [(D1, "M", "app", "USD", "reversa", "aprobado", 20000.0),
            (D2, "M", "app", "USD", "pago", "aprobado", 1.0),
            (D2, "M", "app", "USD", "reversa", "aprobado", 1.0),
            (D2, "M", "app", "USD", "reversa", "aprobado", 60000.0)]
    k = kpis_of(spark, rows)
    assert k[(D1, "M", "app", "USD")].reversal_rate == 0.0
    assert k[(D1, "M", "app", "USD")].risk_score == 20.0   # tier (10000, 50000]
    assert k[(D2, "M", "app", "USD")].reversal_rate == 2.0
    assert k[(D2, "M", "app", "USD")].risk_score == 100.0  # capped


def test_null_group_keys_form_groups(spark):
    rows = [(D1, "M", None, None, "pago", "aprobado", 1.0),
            (D1, "M", None, None, "pago", "aprobado", 2.0)]
    k = kpis_of(spark, rows)
    assert k[(D1, "M", None, None)].total_transactions == 2


def test_alerts_labels(spark):
    kpis = spark.createDataFrame(
        [(0.31, 10.0), (0.30, 59.9), (0.5, 70.0), (0.2, 60.0)], "reversal_rate double, risk_score double")
    got = sorted((r.reversal_rate, r.alert_reason) for r in
                 gold.fraud_alerts(kpis, with_timestamp=False).collect())
    assert got == [(0.2, "high_risk_score"), (0.31, "high_reversal_rate"),
                   (0.5, "high_reversal_rate,high_risk_score")]


def test_summary_left_join_keeps_idle_merchants(spark):
    tx = spark.createDataFrame([(D1, "A", "web", "PEN", "pago", "aprobado", 1.0),
                                (D2, "A", "web", "USD", "reversa", "aprobado", 2.0),
                                (D1, "Z", "web", "PEN", "pago", "aprobado", 9.0)], TX)
    kpis = gold.daily_kpis(tx)
    merchants = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")],
                                      "merchant_id string, merchant_name string")
    s = {r.merchant_id: r for r in gold.merchant_risk_summary(kpis, merchants).collect()}
    assert sorted(s) == ["A", "B"]                 # Z (unknown merchant) does not appear
    assert s["A"].historical_transactions == 2 and s["A"].active_days == 2
    assert s["A"].historical_amount == 3.0        # summed across currencies
    assert s["A"].average_reversal_rate == 0.0    # unweighted mean of (0.0, 0.0)
    assert s["B"].historical_transactions is None  # idle merchant: NULL, not 0


def test_dedup_first_is_deterministic_and_keeps_types(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("k", 2, "b"), (None, 5, "x"),
                                (None, 4, "y"), ("j", 7, "z")], "key string, seq long, v string")
    got = sorted((r.key or "", r.seq, r.v) for r in dedup_first(df, ["key"], "seq").collect())
    assert got == [("", 4, "y"), ("j", 7, "z"), ("k", 1, "a")]
    assert dedup_first(df, ["key"], "seq").columns == df.columns


def test_dedup_pre_reduces_hot_key_before_shuffle(spark):
    # A key holding a large share of rows is reduced map-side: the plan has a
    # partial aggregate below the exchange, so at most one row per key per task
    # crosses the shuffle.
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("seq"))
    plan = dedup_first(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert dedup_first(df, ["k"], "seq").filter(F.col("k").isNull()).collect()[0].seq == 0


@pytest.mark.parametrize("rate,amount,score", [(0.0, 50000.0, 20.0), (0.0, 50000.01, 40.0),
                                               (0.0, 10000.0, 0.0), (1.0, 0.0, 60.0)])
def test_risk_score_tiers_are_strict(spark, rate, amount, score):
    df = spark.createDataFrame([(rate, amount)], "r double, a double")
    assert df.select(gold.risk_score(F.col("r"), F.col("a"))).collect()[0][0] == score


def test_alerts_keep_processed_at_position(spark):
    tx = spark.createDataFrame([(D1, "A", "web", "PEN", "reversa", "aprobado", 1.0)], TX)
    kpis = gold.daily_kpis(tx)
    alerts = gold.fraud_alerts(kpis)
    assert alerts.columns == kpis.columns + ["alert_reason"]
    assert alerts.columns.index("_processed_at") == len(kpis.columns) - 1
