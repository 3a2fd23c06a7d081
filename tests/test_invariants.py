"""Whole-fixture invariants and the expected counts of FIXTURES.md (sf0.01)."""

import pytest
from pyspark.sql import functions as F

from stratum import queries as Q
from stratum.plans import gold

from conftest import SF_MEDIUM


@pytest.fixture(scope="module")
def tx_valid(spark):
    return Q.tx_validated(spark, SF_MEDIUM).cache()


def test_reject_counts_match_fixture_expectations(tx_valid):
    got = {r.rejection_reason: r.n for r in
           tx_valid.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    expected = {
        "transaction_id es nulo": 1, "formato transaction_id invalido": 103, "user_id es nulo": 44,
        "formato user_id invalido": 98, "merchant_id es nulo": 44, "formato merchant_id invalido": 96,
        "amount es nulo": 43, "amount debe ser mayor a 0": 93, "tipo_transaccion invalido": 91,
        "canal invalido": 88, "estado invalido": 78, "moneda invalida": 76,
        "transaction_date invalida": 72, "reversa requiere reference_id": 18,
        "reference_id debe ser nulo": 53, None: 8955}
    assert got == expected


def test_clean_plus_quarantine_is_dedup_input(spark, tx_valid):
    n_keys = Q.tx_dedup(spark, SF_MEDIUM).count()
    assert tx_valid.count() == n_keys == 9953
    clean = tx_valid.filter("rejection_reason IS NULL").count()
    rejected = tx_valid.filter("rejection_reason IS NOT NULL").count()
    assert clean + rejected == n_keys


def test_kpi_totals(spark, tx_valid):
    clean = tx_valid.filter("rejection_reason IS NULL").drop("rejection_reason")
    k = gold.daily_kpis(clean)
    agg = k.agg(F.sum("total_transactions").alias("t"), F.sum("total_payments").alias("p"),
                F.sum("total_reversals").alias("r"), F.sum("total_withdrawals").alias("w"),
                F.min("risk_score").alias("lo"), F.max("risk_score").alias("hi"),
                F.count(F.lit(1)).alias("rows")).collect()[0]
    assert agg.t == clean.count() == 8955
    null_type = clean.filter(F.col("transaction_type").isNull()).count()
    assert agg.p + agg.r + agg.w + null_type == agg.t
    assert 0 <= agg.lo and agg.hi <= 100
    assert agg.rows == 3066
    alerts = gold.fraud_alerts(k)
    assert alerts.count() == 928
    assert alerts.filter("alert_reason = 'high_risk_score'").count() == 0  # implied by the tiers
    assert alerts.filter("risk_score >= 60").count() == 706


def test_merchants_and_summary(spark):
    assert Q.merchants_clean(spark, SF_MEDIUM).count() == 67
    s = Q.gold_merchant_risk_summary(spark, SF_MEDIUM)
    assert s.count() == 67
    assert s.filter(F.col("historical_transactions").isNotNull()).count() == 17


def test_users_counts(spark):
    r = Q.users_row_counts(spark, SF_MEDIUM).collect()[0]
    assert (r.structurally_valid, r.structure_rejects, r.clean, r.quarantined) == \
        (1446, 54, 1131, 315)
    s = Q.users_dq_summary(spark, SF_MEDIUM).collect()[0].asDict()
    assert s == {"invalid_user_id": 24, "invalid_document_id": 22, "invalid_email": 21,
                 "invalid_phone": 18, "invalid_country": 31, "invalid_segment": 145,
                 "invalid_registration_date": 28}
