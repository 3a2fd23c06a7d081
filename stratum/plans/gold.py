"""Gold indicators: daily KPIs, merchant risk summary, fraud alerts.

Plans (checked with ``explain("formatted")``):
  * daily_kpis: one HashAggregate with a partial (map-side) phase, one
    Exchange on the four group keys.  A hot key is pre-reduced per map task.
  * merchant_risk_summary: the distinct count is planned as a
    (merchant, date) partial aggregate first, so a merchant with most of the
    activity is spread over its dates; the per-merchant result has one row per
    merchant and joins the merchant dimension with a left outer join.  We do
    not force a broadcast: Spark (and AQE at runtime, from measured sizes)
    broadcasts the per-merchant side only under
    ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge
    join beyond it.
  * fraud_alerts: a filter over the KPI table - narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# They must equal the source pipeline's for identical results.
# ---------------------------------------------------------------------------
KPI_KEYS = ("transaction_date", "merchant_id", "channel", "currency")
PAYMENT, REVERSAL, WITHDRAWAL, REJECTED = "pago", "reversa", "retiro", "rechazado"
SCORE_CAP = 100.0
RATE_WEIGHT = 60
AMOUNT_TIERS = ((50000, 40), (10000, 20))   # (reversed amount strictly above, points)
ALERT_RATE = 0.30                            # strict >
ALERT_SCORE = 60                             # inclusive >=
ALERT_HIGH_RATE = "high_reversal_rate"
ALERT_HIGH_SCORE = "high_risk_score"
KPI_COLUMNS = ("total_transactions", "total_payments", "total_reversals", "total_withdrawals",
               "total_amount", "average_amount", "reversed_amount", "total_rejected_transactions")
METRIC_COLUMNS = ("historical_transactions", "historical_reversals", "historical_amount",
                  "average_reversal_rate", "maximum_risk_score", "active_days")
# ---------------------------------------------------------------------------


def _is_type(t: str) -> Column:
    return F.col("transaction_type") == F.lit(t)


def reversal_rate(payments: Column, reversals: Column) -> Column:
    """reversals / payments by count; 0.0 when there are no payments."""
    return F.when(payments > 0, reversals / payments).otherwise(F.lit(0.0))


def risk_score(rate: Column, reversed_amount: Column) -> Column:
    tier = None
    for threshold, points in AMOUNT_TIERS:
        cond = reversed_amount > threshold
        tier = F.when(cond, points) if tier is None else tier.when(cond, points)
    return F.least(F.lit(SCORE_CAP), rate * RATE_WEIGHT + tier.otherwise(0))


def kpi_aggregates(tx: DataFrame) -> DataFrame:
    """Group by the four keys (NULL keys form groups); conditional counts and sums."""
    return tx.groupBy(*KPI_KEYS).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(_is_type(PAYMENT)).alias("total_payments"),
        F.count_if(_is_type(REVERSAL)).alias("total_reversals"),
        F.count_if(_is_type(WITHDRAWAL)).alias("total_withdrawals"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"),
        F.sum(F.when(_is_type(REVERSAL), F.col("amount")).otherwise(0)).alias("reversed_amount"),
        F.count_if(F.col("status") == F.lit(REJECTED)).alias("total_rejected_transactions"),
    )


# Additive KPI measures: a KPI row for new data merges with the stored row by summing.
ADDITIVE_KPIS = ("total_transactions", "total_payments", "total_reversals", "total_withdrawals",
                 "total_amount", "reversed_amount", "total_rejected_transactions")


def kpi_partials(tx: DataFrame) -> DataFrame:
    """The additive measures of some clean transactions, one row per group."""
    return kpi_aggregates(tx.select("transaction_date", "merchant_id", "channel", "currency",
                                    "transaction_type", "status", "amount")).select(
        *KPI_KEYS, *ADDITIVE_KPIS)


def combine_partials(partials: DataFrame) -> DataFrame:
    """One row per group (NULL keys group together, as in the full computation)."""
    return partials.groupBy(*KPI_KEYS).agg(*[F.sum(c).alias(c) for c in ADDITIVE_KPIS])


def kpis_from_partials(partials: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """The KPI rows that the partials of all deliveries add up to.

    ``average_amount`` is total_amount / total_transactions, equal to the mean
    because clean rows never have a NULL amount.
    """
    return _derive(combine_partials(partials).withColumn(
        "average_amount", F.col("total_amount") / F.col("total_transactions")),
        with_timestamp)


def _derive(kpis: DataFrame, with_timestamp: bool) -> DataFrame:
    kpis = kpis.select(*KPI_KEYS, *KPI_COLUMNS)
    kpis = kpis.withColumn("reversal_rate",
                           reversal_rate(F.col("total_payments"), F.col("total_reversals")))
    kpis = kpis.withColumn("risk_score",
                           risk_score(F.col("reversal_rate"), F.col("reversed_amount")))
    if with_timestamp:
        kpis = kpis.withColumn("_processed_at", F.current_timestamp())
    return kpis


def daily_kpis(tx: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """silver.transactions -> gold.daily_transaction_kpis."""
    kpis = kpi_aggregates(tx.select("transaction_date", "merchant_id", "channel", "currency",
                                    "transaction_type", "status", "amount"))
    return _derive(kpis, with_timestamp)


def merchant_metrics(kpis: DataFrame) -> DataFrame:
    """Per-merchant roll-up of the KPI table (amounts summed across currencies,
    unweighted mean of group rates, distinct active dates)."""
    measures = (F.sum("total_transactions"), F.sum("total_reversals"), F.sum("total_amount"),
                F.avg("reversal_rate"), F.max("risk_score"), F.count_distinct("transaction_date"))
    return kpis.groupBy("merchant_id").agg(
        *[m.alias(name) for m, name in zip(measures, METRIC_COLUMNS)])


def merchant_risk_summary(kpis: DataFrame, merchants: DataFrame,
                          with_timestamp: bool = True) -> DataFrame:
    """silver.merchants LEFT JOIN per-merchant metrics USING (merchant_id).

    Idle merchants get NULL metrics; activity of merchants absent from the
    clean dimension does not appear.
    """
    summary = merchants.join(merchant_metrics(kpis), on="merchant_id", how="left")
    if with_timestamp:
        summary = summary.withColumn("_processed_at", F.current_timestamp())
    return summary


def alert_predicate() -> Column:
    return (F.col("reversal_rate") > ALERT_RATE) | (F.col("risk_score") >= ALERT_SCORE)


def alert_reason() -> Column:
    return F.concat_ws(",",
                       F.when(F.col("reversal_rate") > ALERT_RATE, F.lit(ALERT_HIGH_RATE)),
                       F.when(F.col("risk_score") >= ALERT_SCORE, F.lit(ALERT_HIGH_SCORE)))


def fraud_alerts(kpis: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """KPI rows over a threshold, with the comma-joined labels that apply."""
    alerts = kpis.filter(alert_predicate()).withColumn("alert_reason", alert_reason())
    if with_timestamp:
        # Replaces the KPI table's timestamp in place (same column position).
        alerts = alerts.withColumn("_processed_at", F.current_timestamp())
    elif "_processed_at" in alerts.columns:
        alerts = alerts.drop("_processed_at")
    return alerts
