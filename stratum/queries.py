"""Registered queries: one per operator / data product, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the shared test tables (through the dirty fixtures derived
from them) in full; nothing is sampled or capped.  Columns that hold the
processing time are left out so results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.normalize import parse_amount, parse_date
from stratum.plans import gold, merchants, transactions, users
from stratum.session import ensure_checkpoint_dir
from stratum.sources import fixtures
from stratum.sources.landing import write_text
from stratum.sources.tables import delete_path, overwrite, read_partitioned, read_path
from stratum.streaming import flows, staging
from stratum.streaming.pipeline import KPI_TABLE, Pipeline, complete_batches

Query = Callable[[SparkSession, str], DataFrame]


# --- transactions ---------------------------------------------------------------------------

def tx_parse_amount(spark, sf_dir):
    raw = fixtures.raw_transactions(spark, sf_dir)
    return raw.select("_seq", F.col("amount").alias("amount_raw"),
                      parse_amount("amount").alias("amount"))


def tx_fold_and_recode(spark, sf_dir):
    norm = transactions.normalize(fixtures.raw_transactions(spark, sf_dir))
    return norm.select("_seq", "transaction_type", "channel", "status", "currency")


def tx_parse_date(spark, sf_dir):
    raw = fixtures.raw_transactions(spark, sf_dir)
    return raw.select("_seq", F.col("transaction_date").alias("transaction_date_raw"),
                      parse_date("transaction_date", transactions.DATE_FORMATS)
                      .alias("transaction_date"))


def tx_dedup(spark, sf_dir):
    return transactions.dedup(transactions.normalize(fixtures.raw_transactions(spark, sf_dir)))


def tx_validated(spark, sf_dir):
    return transactions.validate(fixtures.raw_transactions(spark, sf_dir))


def _reason_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def tx_rejection_counts(spark, sf_dir):
    return _reason_counts(tx_validated(spark, sf_dir))


def tx_clean(spark, sf_dir):
    return transactions.clean(tx_validated(spark, sf_dir))


def _quarantine_fields(q: DataFrame) -> DataFrame:
    """Check the JSON envelope by extracting fields back out of it."""
    rec = F.col("original_record")
    key = F.when(F.col("source_name") == F.lit(transactions.SOURCE_NAME),
                 F.get_json_object(rec, "$.transaction_id")).otherwise(
        F.get_json_object(rec, "$.merchant_id"))
    return q.select(
        "source_name", "rejection_reason",
        F.get_json_object(rec, "$._seq").cast("bigint").alias("record_seq"),
        key.alias("record_key"),
        F.get_json_object(rec, "$.rejection_reason").alias("record_reason"),
        F.get_json_object(rec, "$.amount").cast("double").alias("record_amount"),
        F.get_json_object(rec, "$.status").alias("record_status"),
        F.get_json_object(rec, "$.country").alias("record_country"),
    )


def tx_quarantine(spark, sf_dir):
    return _quarantine_fields(transactions.quarantine(tx_validated(spark, sf_dir)))


# --- merchants ------------------------------------------------------------------------------

def merchants_normalized(spark, sf_dir):
    return merchants.normalize(fixtures.raw_merchants(spark, sf_dir))


def merchants_validated(spark, sf_dir):
    return merchants.validate(fixtures.raw_merchants(spark, sf_dir))


def merchants_rejection_counts(spark, sf_dir):
    return _reason_counts(merchants_validated(spark, sf_dir))


def merchants_clean(spark, sf_dir):
    return merchants.clean(merchants_validated(spark, sf_dir))


def merchants_quarantine(spark, sf_dir):
    return _quarantine_fields(merchants.quarantine(merchants_validated(spark, sf_dir)))


def quarantine_all(spark, sf_dir):
    """Both reject flows fanned into one quarantine relation (union all)."""
    q = transactions.quarantine(tx_validated(spark, sf_dir)).unionByName(
        merchants.quarantine(merchants_validated(spark, sf_dir)))
    return _quarantine_fields(q)


# --- users ----------------------------------------------------------------------------------

KEEP = ("_seq",)


def _raw_users(spark, sf_dir):
    """The users lines with lineage cut (reliable checkpoint in the shared folder).

    In the pipeline the lines come from the stored bronze table; here they are
    computed from the test tables, and without the cut Catalyst would inline
    that whole computation into every pushed-down flag filter.
    """
    ensure_checkpoint_dir(spark)  # the session's shared folder; set only if unset
    return fixtures.raw_users(spark, sf_dir).checkpoint(eager=True)


def users_structural_split(spark, sf_dir):
    ok, _ = users.split_lines(_raw_users(spark, sf_dir), keep=KEEP)
    return ok


def users_structural_quarantine(spark, sf_dir):
    _, bad = users.split_lines(_raw_users(spark, sf_dir), keep=KEEP)
    return bad.select("_seq", "value", F.size("parts").alias("n_parts"), "error_type",
                      "error_reason")


def users_normalized(spark, sf_dir):
    ok, _ = users.split_lines(_raw_users(spark, sf_dir), keep=KEEP)
    return users.normalize(ok)


def users_phone(spark, sf_dir):
    return users.phone_columns(users_normalized(spark, sf_dir)).select(
        "_seq", "phone", "country", "phone_has_letters", "phone_clean", "is_valid_phone_format",
        "phone_country_code", "phone_country_match")


def users_flags(spark, sf_dir):
    return users.validated(_raw_users(spark, sf_dir), keep=KEEP)


def users_dq_summary(spark, sf_dir):
    return users.summary(users_flags(spark, sf_dir))


def users_clean(spark, sf_dir):
    good, _ = users.clean_and_quarantine(users_flags(spark, sf_dir))
    return good


def users_quarantine(spark, sf_dir):
    _, bad = users.clean_and_quarantine(users_flags(spark, sf_dir))
    return bad.drop("_quarantine_timestamp")


def users_row_counts(spark, sf_dir):
    return users.row_counts(_raw_users(spark, sf_dir))


def users_invalid_email(spark, sf_dir):
    return users.invalid_email(users_flags(spark, sf_dir))


def users_invalid_phone_report(spark, sf_dir):
    return users.invalid_phone_report(users_flags(spark, sf_dir))


# --- gold -----------------------------------------------------------------------------------

def _kpis(spark, sf_dir, with_timestamp=False):
    return gold.daily_kpis(tx_clean(spark, sf_dir), with_timestamp=with_timestamp)


def gold_daily_kpis(spark, sf_dir):
    return _kpis(spark, sf_dir)


def gold_conditional_counts(spark, sf_dir):
    return gold.kpi_aggregates(tx_clean(spark, sf_dir)).select(
        *gold.KPI_KEYS, "total_payments", "total_reversals", "total_withdrawals",
        "total_rejected_transactions", "reversed_amount")


def gold_reversal_rate(spark, sf_dir):
    return _kpis(spark, sf_dir).select(*gold.KPI_KEYS, "total_payments", "total_reversals",
                                       "reversal_rate")


def gold_risk_score(spark, sf_dir):
    return _kpis(spark, sf_dir).select(*gold.KPI_KEYS, "reversal_rate", "reversed_amount",
                                       "risk_score")


def _round_rate(df: DataFrame) -> DataFrame:
    # A mean of doubles depends on summation order in its last bits.
    return df.withColumn("average_reversal_rate", F.round("average_reversal_rate", 9))


def gold_merchant_metrics(spark, sf_dir):
    return _round_rate(gold.merchant_metrics(_kpis(spark, sf_dir)))


def gold_merchant_risk_summary(spark, sf_dir):
    return _round_rate(gold.merchant_risk_summary(_kpis(spark, sf_dir),
                                                  merchants_clean(spark, sf_dir),
                                                  with_timestamp=False))


def gold_fraud_alerts(spark, sf_dir):
    return gold.fraud_alerts(_kpis(spark, sf_dir), with_timestamp=False)


def gold_alert_reason_counts(spark, sf_dir):
    return gold_fraud_alerts(spark, sf_dir).groupBy("alert_reason").agg(
        F.count(F.lit(1)).alias("n_alerts"))


# --- streaming: landing files -> bronze -> silver -> gold ----------------------------------
#
# These stage the fixtures as landing files under the shared checkpoint folder
# (a fresh run directory per call) and run the Structured Streaming flows with
# an available-now trigger; the result is read back from the flows' tables.

def _bronze_rows(spark, layout, source):
    return flows.bronze_table(spark, layout, source).drop("_ingestion_timestamp", "_source_file")


def _ingest_once(spark, sf_dir, source, fmt):
    layout = staging.fresh_layout(spark, f"ingest_{fmt}")
    raw = staging.FIXTURE_READERS[source](spark, sf_dir)
    spec = staging.stage(spark, layout, source, raw, fmt)
    flows.ingest(spark, layout, spec)
    return layout


def ingest_json_stream(spark, sf_dir):
    """JSON array files -> typed bronze (inferred types, no misfits, lineage dropped)."""
    return _bronze_rows(spark, _ingest_once(spark, sf_dir, "transactions", "json"), "transactions")


def ingest_csv_stream(spark, sf_dir):
    return _bronze_rows(spark, _ingest_once(spark, sf_dir, "merchants", "csv"), "merchants")


def ingest_text_stream(spark, sf_dir):
    return _bronze_rows(spark, _ingest_once(spark, sf_dir, "users", "text"), "users")


def ingest_parquet_stream(spark, sf_dir):
    return _bronze_rows(spark, _ingest_once(spark, sf_dir, "transactions", "parquet"),
                        "transactions")


def ingest_source_file_lineage(spark, sf_dir):
    """Rows per landing file name as recorded by the ingest (lineage column)."""
    layout = _ingest_once(spark, sf_dir, "users", "text")
    b = flows.bronze_table(spark, layout, "users")
    return b.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count("_source_file").alias("n_with_source_file"),
                 F.count_if(F.col("_source_file").endswith(".txt")).alias("n_txt_files"))


def ingest_schema_evolution(spark, sf_dir):
    """Second delivery carries a new column: it is appended, older rows read NULL."""
    layout = staging.fresh_layout(spark, "ingest_schema_evolution")
    raw = fixtures.raw_transactions(spark, sf_dir)
    spec = staging.stage(spark, layout, "transactions", staging.first_copies(raw), "json")
    flows.ingest(spark, layout, spec)
    late = staging.late_copies(raw).withColumn("device", F.upper(F.trim("channel")))
    staging.stage(spark, layout, "transactions", late, "json")
    flows.ingest(spark, layout, spec)
    return _bronze_rows(spark, layout, "transactions")


def ingest_rescued_data(spark, sf_dir):
    """Second delivery writes ``_seq`` as text: the value is rescued, not lost."""
    layout = staging.fresh_layout(spark, "ingest_rescued_data")
    raw = fixtures.raw_transactions(spark, sf_dir)
    spec = staging.stage(spark, layout, "transactions", staging.first_copies(raw), "json")
    flows.ingest(spark, layout, spec)
    late = staging.late_copies(raw).withColumn("_seq", F.concat(F.lit("#"), F.col("_seq")))
    staging.stage(spark, layout, "transactions", late, "json")
    flows.ingest(spark, layout, spec)
    return _bronze_rows(spark, layout, "transactions")


def ingest_rescued_nested(spark, sf_dir):
    """Second delivery writes a text inside a nested column: kept whole in the rescue."""
    layout = staging.fresh_layout(spark, "ingest_rescued_nested")
    raw = fixtures.raw_transactions(spark, sf_dir).select("_seq", "transaction_id")
    first = staging.first_copies(raw).withColumn("detail", F.struct(F.col("_seq").alias("n")))
    spec = staging.stage(spark, layout, "transactions", first, "json")
    flows.ingest(spark, layout, spec)
    late = staging.late_copies(raw).withColumn(
        "detail", F.struct(F.concat(F.lit("#"), F.col("_seq")).alias("n")))
    staging.stage(spark, layout, "transactions", late, "json")
    flows.ingest(spark, layout, spec)
    b = flows.bronze_table(spark, layout, "transactions")
    return b.select("_seq", "transaction_id", F.col("detail.n").alias("detail_n"),
                    F.get_json_object(F.get_json_object("_rescued_data", "$.detail"), "$.n")
                    .alias("rescued_n"))


def ingest_csv_two_date_formats(spark, sf_dir):
    """ISO dates first, the others later, late copies last: the date column stays text,
    and the streamed rules accept both forms as the batch does."""
    layout = staging.fresh_layout(spark, "ingest_csv_two_date_formats")
    raw = fixtures.raw_merchants(spark, sf_dir)
    first = staging.first_copies(raw)
    iso = F.coalesce(F.col("affiliation_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    pipe = Pipeline(spark, layout, [staging.spec_for(layout, "merchants", "csv")],
                    register_tables=False)
    for part in (first.filter(iso), first.filter(~iso), staging.late_copies(raw)):
        staging.stage(spark, layout, "merchants", part, "csv")
        pipe.run_bronze()
        pipe.run_silver()
    v = read_path(spark, layout.table_path("silver.merchants_validated"))
    return v.drop("_rescued_data", "_source_file")


def ingest_late_column(spark, sf_dir):
    """The second delivery has a new column and older file times than the first one."""
    layout = staging.fresh_layout(spark, "ingest_late_column")
    raw = fixtures.raw_transactions(spark, sf_dir)
    spec = staging.stage(spark, layout, "transactions", staging.first_copies(raw), "json")
    flows.ingest(spark, layout, spec)
    late = staging.late_copies(raw).withColumn("device", F.upper(F.trim("channel")))
    staging.stage(spark, layout, "transactions", late, "json")
    staging.age_files(spark, spec.source_path, 7200)
    flows.ingest(spark, layout, spec)
    return _bronze_rows(spark, layout, "transactions")


def ingest_csv_mixed_headers(spark, sf_dir):
    """Three kinds of CSV files in one delivery, with the columns in order, reversed, and
    with one more in front; then the late copies, reversed, with older file times."""
    layout = staging.fresh_layout(spark, "ingest_csv_mixed_headers")
    raw = fixtures.raw_merchants(spark, sf_dir)
    first, back = staging.first_copies(raw), raw.columns[::-1]
    kind = F.col("_seq") % 3
    wide = first.filter(kind == 2).withColumn("code", F.lpad(F.col("_seq").cast("string"), 9, "0"))
    for part in (first.filter(kind == 0), first.filter(kind == 1).select(*back),
                 wide.select("code", *raw.columns)):
        spec = staging.stage(spark, layout, "merchants", part, "csv")
    flows.ingest(spark, layout, spec)
    staging.stage(spark, layout, "merchants", staging.late_copies(raw).select(*back), "csv")
    staging.age_files(spark, spec.source_path, 7200)
    flows.ingest(spark, layout, spec)
    return _bronze_rows(spark, layout, "merchants")


def ingest_rescued_unknown_column(spark, sf_dir):
    """A source that keeps its first columns: a later one stays in the rescued data."""
    layout = staging.fresh_layout(spark, "ingest_rescued_unknown_column")
    raw = fixtures.raw_transactions(spark, sf_dir)
    spec = replace(staging.stage(spark, layout, "transactions", staging.first_copies(raw), "json"),
                   options={"evolution": "rescue"})
    flows.ingest(spark, layout, spec)
    late = staging.late_copies(raw).withColumn("device", F.upper(F.trim("channel")))
    staging.stage(spark, layout, "transactions", late, "json")
    flows.ingest(spark, layout, spec)
    return _bronze_rows(spark, layout, "transactions")


def ingest_rescued_malformed(spark, sf_dir):
    """JSON Lines, with the lines of the late copies cut off: their text is kept."""
    layout = staging.fresh_layout(spark, "ingest_rescued_malformed")
    raw = fixtures.raw_transactions(spark, sf_dir).select("_seq", "transaction_id")
    spec = replace(staging.spec_for(layout, "transactions", "json"), options={"multiline": False})
    whole = F.to_json(F.struct("_seq", "transaction_id"))
    cut = F.concat(F.lit('{"_seq":'), F.col("_seq").cast("string"), F.lit(',"transac'))
    lines = raw.select(F.when(F.col("_seq") < staging.LATE_OFFSET, whole).otherwise(cut)
                       .alias("value"))
    write_text(lines, spec.source_path)
    flows.ingest(spark, layout, spec)
    b = _bronze_rows(spark, layout, "transactions")
    text = F.get_json_object("_rescued_data", "$._corrupt_record")
    return b.select(F.when(text.isNull(), F.col("_seq")).alias("_seq"), "transaction_id",
                    text.alias("corrupt"))


def ingest_timestamps(spark, sf_dir):
    """Two deliveries: each micro-batch has one ingestion time, no row lacks it."""
    layout = staging.fresh_layout(spark, "ingest_timestamps")
    raw = fixtures.raw_transactions(spark, sf_dir)
    for part in (staging.first_copies(raw), staging.late_copies(raw)):
        spec = staging.stage(spark, layout, "transactions", part, "json")
        flows.ingest(spark, layout, spec)
    b = flows.bronze_table(spark, layout, "transactions")
    late = F.col("_seq") >= staging.LATE_OFFSET
    at = F.col("_ingestion_timestamp")
    return b.agg(F.count(F.lit(1)).alias("n_rows"), F.count(at).alias("n_with_time"),
                 F.count_distinct(at).alias("n_times"),
                 (F.max(F.when(~late, at)) < F.min(F.when(late, at))).alias("in_order"),
                 (F.max(at) <= F.current_timestamp()).alias("not_in_the_future"))


def gold_processed_at(spark, sf_dir):
    """The processing time of the KPI rows: one value for all, set on every row."""
    kpis = _kpis(spark, sf_dir, with_timestamp=True)
    at = F.col("_processed_at")
    return kpis.agg(F.count(F.lit(1)).alias("n_rows"), F.count(at).alias("n_with_time"),
                    F.count_distinct(at).alias("n_times"),
                    (F.max(at) <= F.current_timestamp()).alias("not_in_the_future"))


def _two_delivery_silver(spark, sf_dir, name, sources=("transactions", "merchants")):
    """Deliver first copies, run bronze+silver; deliver late copies, run again."""
    layout = staging.fresh_layout(spark, name)
    raws = {s: staging.FIXTURE_READERS[s](spark, sf_dir) for s in sources}
    specs = [staging.spec_for(layout, s, staging.DEFAULT_FORMATS[s]) for s in sources]
    pipe = Pipeline(spark, layout, specs, register_tables=False)
    for pick in (staging.first_copies, staging.late_copies):
        for s in sources:
            staging.stage(spark, layout, s, pick(raws[s]), staging.DEFAULT_FORMATS[s])
        pipe.run_bronze()
        pipe.run_silver()
    return layout, pipe


def stream_dedup_across_batches(spark, sf_dir):
    """Keys of the streamed validated table: later copies were dropped by state."""
    layout, _ = _two_delivery_silver(spark, sf_dir, "stream_dedup", ("transactions",))
    v = read_path(spark, layout.table_path("silver.transactions_validated"))
    return v.select("transaction_id")


def _validated_keys(spark, sf_dir, name, opts, key):
    """Keys of the validated table after the first copies and the late ones."""
    layout = staging.fresh_layout(spark, name)
    raw = fixtures.raw_transactions(spark, sf_dir).withColumn("transaction_id", key)
    pipe = Pipeline(spark, layout, [staging.spec_for(layout, "transactions", "json")], opts,
                    register_tables=False)
    for part in (staging.first_copies(raw), staging.late_copies(raw)):
        staging.stage(spark, layout, "transactions", part, "json")
        pipe.run_bronze()
        flows.validated(spark, layout, "transactions", opts, pipe._bronze_schema("transactions"))
    return read_path(spark, layout.table_path("silver.transactions_validated")).select(
        "transaction_id")


def stream_dedup_hot_key(spark, sf_dir):
    """A third of all rows have the key ``N/A``, which the sketch finds and spreads."""
    key = F.when(F.col("_seq") % 3 == 0, F.lit("N/A")).otherwise(F.col("transaction_id"))
    return _validated_keys(spark, sf_dir, "stream_dedup_hot_key", flows.FlowOptions(), key)


def stream_dedup_bounded(spark, sf_dir):
    """Dedup state bounded to a week after the first copy; all copies arrive within it."""
    return _validated_keys(spark, sf_dir, "stream_dedup_bounded",
                           flows.FlowOptions(dedup_within="7 days"), F.col("transaction_id"))


def stream_quarantine_fan_in(spark, sf_dir):
    layout, _ = _two_delivery_silver(spark, sf_dir, "stream_quarantine")
    q = flows.quarantine_table(spark, layout)
    return _quarantine_fields(q).select("source_name", "rejection_reason", "record_key",
                                        "record_reason")


def stream_silver_end_to_end(spark, sf_dir):
    """Landing files -> bronze -> silver streams -> gold KPIs (batch) = batch KPIs."""
    layout, pipe = _two_delivery_silver(spark, sf_dir, "stream_e2e", ("transactions",))
    pipe.run_gold()
    kpis = read_path(spark, layout.table_path(KPI_TABLE))
    return kpis.drop("_processed_at")


def stream_gold_incremental(spark, sf_dir):
    """Three deliveries in arrival order (earlier events, later events, late copies);
    gold is refreshed after each, incrementally by date; the end state must
    equal the KPIs computed in one batch over the whole fixture."""
    layout = staging.fresh_layout(spark, "stream_gold_incremental")
    raw = fixtures.raw_transactions(spark, sf_dir)
    first = staging.first_copies(raw)
    n = first.count()
    spec = staging.spec_for(layout, "transactions", "json")
    pipe = Pipeline(spark, layout, [spec], register_tables=False)
    for part in (first.filter(F.col("_seq") < n // 2), first.filter(F.col("_seq") >= n // 2),
                 staging.late_copies(raw)):
        staging.stage(spark, layout, "transactions", part, "json")
        pipe.run_bronze()
        pipe.run_silver()
        pipe.run_gold()
    return read_path(spark, layout.table_path(KPI_TABLE)).drop("_processed_at")


def stream_gold_after_crash(spark, sf_dir):
    """A refresh that lost its last micro-batch's commit and its pointer (it stopped after
    replacing the KPI dates), then a later delivery for the same dates: nothing counts
    twice."""
    layout = staging.fresh_layout(spark, "stream_gold_after_crash")
    raw = fixtures.raw_transactions(spark, sf_dir)
    pipe = Pipeline(spark, layout, [staging.spec_for(layout, "transactions", "json")],
                    register_tables=False)
    state = layout.checkpoint("gold_daily_transaction_kpis")
    first = staging.first_copies(raw)
    for part in (first.filter(F.col("_seq") % 3 < 2), first.filter(F.col("_seq") % 3 == 2),
                 staging.late_copies(raw)):
        staging.stage(spark, layout, "transactions", part, "json")
        pipe.run_bronze()
        pipe.run_silver()
        pipe.run_gold()
        last = complete_batches(spark, f"{state}/partials")[-1]
        delete_path(spark, f"{state}/pointer")
        delete_path(spark, f"{state}/stream/commits/{last}")
    pipe.run_gold()
    return read_path(spark, layout.table_path(KPI_TABLE)).drop("_processed_at")


def stream_after_full_refresh(spark, sf_dir):
    """Refreshing the validated table rebuilds all that is derived from it, once."""
    layout, pipe = _two_delivery_silver(spark, sf_dir, "stream_refresh", ("transactions",))
    pipe.run_gold()
    pipe.full_refresh("silver.transactions_validated")
    pipe.run_silver()
    pipe.run_gold()
    return read_path(spark, layout.table_path(KPI_TABLE)).drop("_processed_at")


def kpis_partitioned_roundtrip(spark, sf_dir):
    """KPI table written partitioned by date and read back whole."""
    layout = staging.fresh_layout(spark, "kpis_partitioned")
    kpis = _kpis(spark, sf_dir)
    path = layout.table_path(KPI_TABLE)
    overwrite(kpis, path, partition_by=("transaction_date",))
    return read_partitioned(spark, path, kpis.columns)


QUERIES: dict[str, Query] = {
    "tx_parse_amount": tx_parse_amount,
    "tx_fold_and_recode": tx_fold_and_recode,
    "tx_parse_date": tx_parse_date,
    "tx_dedup": tx_dedup,
    "tx_validated": tx_validated,
    "tx_rejection_counts": tx_rejection_counts,
    "tx_clean": tx_clean,
    "tx_quarantine": tx_quarantine,
    "merchants_normalized": merchants_normalized,
    "merchants_validated": merchants_validated,
    "merchants_rejection_counts": merchants_rejection_counts,
    "merchants_clean": merchants_clean,
    "merchants_quarantine": merchants_quarantine,
    "quarantine_all": quarantine_all,
    "users_structural_split": users_structural_split,
    "users_structural_quarantine": users_structural_quarantine,
    "users_normalized": users_normalized,
    "users_phone": users_phone,
    "users_flags": users_flags,
    "users_dq_summary": users_dq_summary,
    "users_clean": users_clean,
    "users_quarantine": users_quarantine,
    "users_row_counts": users_row_counts,
    "users_invalid_email": users_invalid_email,
    "users_invalid_phone_report": users_invalid_phone_report,
    "gold_daily_kpis": gold_daily_kpis,
    "gold_conditional_counts": gold_conditional_counts,
    "gold_reversal_rate": gold_reversal_rate,
    "gold_risk_score": gold_risk_score,
    "gold_merchant_metrics": gold_merchant_metrics,
    "gold_merchant_risk_summary": gold_merchant_risk_summary,
    "gold_fraud_alerts": gold_fraud_alerts,
    "gold_alert_reason_counts": gold_alert_reason_counts,
    "kpis_partitioned_roundtrip": kpis_partitioned_roundtrip,
    "ingest_json_stream": ingest_json_stream,
    "ingest_csv_stream": ingest_csv_stream,
    "ingest_text_stream": ingest_text_stream,
    "ingest_parquet_stream": ingest_parquet_stream,
    "ingest_source_file_lineage": ingest_source_file_lineage,
    "ingest_schema_evolution": ingest_schema_evolution,
    "ingest_rescued_data": ingest_rescued_data,
    "ingest_rescued_nested": ingest_rescued_nested,
    "ingest_csv_two_date_formats": ingest_csv_two_date_formats,
    "ingest_late_column": ingest_late_column,
    "ingest_csv_mixed_headers": ingest_csv_mixed_headers,
    "ingest_rescued_unknown_column": ingest_rescued_unknown_column,
    "ingest_rescued_malformed": ingest_rescued_malformed,
    "ingest_timestamps": ingest_timestamps,
    "gold_processed_at": gold_processed_at,
    "stream_dedup_across_batches": stream_dedup_across_batches,
    "stream_dedup_hot_key": stream_dedup_hot_key,
    "stream_dedup_bounded": stream_dedup_bounded,
    "stream_quarantine_fan_in": stream_quarantine_fan_in,
    "stream_silver_end_to_end": stream_silver_end_to_end,
    "stream_gold_incremental": stream_gold_incremental,
    "stream_gold_after_crash": stream_gold_after_crash,
    "stream_after_full_refresh": stream_after_full_refresh,
}
