"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in DuckDB's dialect against the pre-registered views of the
test tables; it shares only the fixture text with the Spark side.  Notes on
dialect gaps:
  * strict date parsing = a regex shape gate + ``try_strptime``;
  * Spark ``rlike`` = ``regexp_matches``; ``regexp_replace`` needs ``'g'``;
  * arrays are 1-based; ``sum`` of integers is HUGEINT, so counts are cast.
"""

from __future__ import annotations

from stratum.sources.fixtures import oracle_fixture_sql


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes)


def _strict_date(col: str, fmts: list[tuple[str, str]]) -> str:
    parts = [f"CASE WHEN regexp_matches({col}, '{shape}') "
             f"THEN CAST(try_strptime({col}, '{fmt}') AS DATE) END" for shape, fmt in fmts]
    return parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"


# ---------------------------------------------------------------------------
# The reasons, patterns, aliases, value lists, thresholds and column names in
# the SQL below are the source pipeline's, stated here once more as plain text.
# ---------------------------------------------------------------------------
ISO = (r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d")
DMY = (r"^\d{2}/\d{2}/\d{4}$", "%d/%m/%Y")

RAW_TX = ("raw_tx", oracle_fixture_sql("raw_transactions"))
RAW_M = ("raw_m", oracle_fixture_sql("raw_merchants"))
RAW_U = ("raw_u", oracle_fixture_sql("raw_users"))

AMOUNT_SQL = ("TRY_CAST(replace(CASE WHEN contains(amount, ',') AND contains(amount, '.') "
              "THEN replace(amount, '.', '') ELSE amount END, ',', '.') AS DOUBLE)")

TX_NORM = ("tx_norm", f"""
SELECT _seq, transaction_id, user_id, merchant_id,
  {AMOUNT_SQL} AS amount,
  CASE WHEN lower(trim(transaction_type)) = 'payment' THEN 'pago'
       ELSE lower(trim(transaction_type)) END AS transaction_type,
  lower(trim(channel)) AS channel,
  lower(trim(status)) AS status,
  CASE upper(trim(currency)) WHEN 'SOL' THEN 'PEN' WHEN 'SOLES' THEN 'PEN' WHEN 'US$' THEN 'USD'
       ELSE upper(trim(currency)) END AS currency,
  {_strict_date('transaction_date', [ISO, DMY])} AS transaction_date,
  reference_id
FROM raw_tx""")

TX_DEDUP = ("tx_dedup", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _seq) AS rn FROM tx_norm)
WHERE rn = 1""")

TX_VALID = ("tx_valid", r"""
SELECT *, CASE
  WHEN transaction_id IS NULL THEN 'transaction_id es nulo'
  WHEN NOT regexp_matches(transaction_id, '^TXN-\d{8}-\d{5}$') THEN 'formato transaction_id invalido'
  WHEN user_id IS NULL THEN 'user_id es nulo'
  WHEN NOT regexp_matches(user_id, '^USR-\d{6}$') THEN 'formato user_id invalido'
  WHEN merchant_id IS NULL THEN 'merchant_id es nulo'
  WHEN NOT regexp_matches(merchant_id, '^MCH-\d{5}$') THEN 'formato merchant_id invalido'
  WHEN amount IS NULL THEN 'amount es nulo'
  WHEN amount <= 0 THEN 'amount debe ser mayor a 0'
  WHEN NOT (transaction_type IN ('pago', 'reversa', 'retiro')) THEN 'tipo_transaccion invalido'
  WHEN NOT (channel IN ('web', 'app', 'pos')) THEN 'canal invalido'
  WHEN NOT (status IN ('aprobado', 'rechazado', 'pendiente')) THEN 'estado invalido'
  WHEN NOT (currency IN ('PEN', 'USD', 'COP', 'MXN', 'CLP', 'ARS')) THEN 'moneda invalida'
  WHEN transaction_date IS NULL THEN 'transaction_date invalida'
  WHEN transaction_type = 'reversa' AND reference_id IS NULL THEN 'reversa requiere reference_id'
  WHEN transaction_type <> 'reversa' AND reference_id IS NOT NULL THEN 'reference_id debe ser nulo'
END AS rejection_reason
FROM tx_dedup""")

TX_CLEAN = ("tx_clean", "SELECT * EXCLUDE (rejection_reason) FROM tx_valid WHERE rejection_reason IS NULL")

TX_CHAIN = (RAW_TX, TX_NORM, TX_DEDUP, TX_VALID, TX_CLEAN)

M_NORM = ("m_norm", f"""
SELECT _seq, merchant_id, merchant_name,
  lower(trim(category)) AS category,
  upper(CASE lower(trim(country))
    WHEN 'peru' THEN 'PE' WHEN 'per' THEN 'PE' WHEN 'colombia' THEN 'CO' WHEN 'col' THEN 'CO'
    WHEN 'mexico' THEN 'MX' WHEN 'mex' THEN 'MX' WHEN 'chile' THEN 'CL' WHEN 'chi' THEN 'CL'
    WHEN 'argentina' THEN 'AR' WHEN 'arg' THEN 'AR' ELSE lower(trim(country)) END) AS country,
  {_strict_date('affiliation_date', [ISO, DMY])} AS affiliation_date,
  CASE WHEN lower(trim(status)) = 'suspended' THEN 'suspendido' ELSE lower(trim(status)) END AS status,
  lower(trim(risk_level)) AS risk_level
FROM raw_m""")

M_DEDUP = ("m_dedup", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY _seq) AS rn FROM m_norm)
WHERE rn = 1""")

M_VALID = ("m_valid", r"""
SELECT *, CASE
  WHEN merchant_id IS NULL THEN 'merchant_id es nulo'
  WHEN NOT regexp_matches(merchant_id, '^MCH-\d{5}$') THEN 'formato merchant_id invalido'
  WHEN merchant_name IS NULL OR trim(merchant_name) = '' THEN 'merchant_name vacio'
  WHEN NOT (category IN ('retail', 'restaurante', 'farmacia', 'supermercado', 'tecnologia',
                         'transporte', 'educacion', 'salud', 'entretenimiento', 'moda'))
    THEN 'categoria invalida'
  WHEN NOT (country IN ('PE', 'CO', 'MX', 'CL', 'AR')) THEN 'pais invalido'
  WHEN affiliation_date IS NULL THEN 'affiliation_date invalida'
  WHEN NOT (status IN ('activo', 'inactivo', 'suspendido')) THEN 'estado invalido'
  WHEN risk_level IS NOT NULL AND NOT (risk_level IN ('bajo', 'medio', 'alto')) THEN 'risk_level invalido'
END AS rejection_reason
FROM m_dedup""")

M_CLEAN = ("m_clean", "SELECT * EXCLUDE (rejection_reason) FROM m_valid WHERE rejection_reason IS NULL")

M_CHAIN = (RAW_M, M_NORM, M_DEDUP, M_VALID, M_CLEAN)

U_FIELDS_ALL = ("u_split", "SELECT _seq, value, string_split(value, '|') AS parts FROM raw_u")
U_FIELDS = ("u_fields", """
SELECT _seq, parts[1] AS user_id, parts[2] AS full_name, parts[3] AS document_id, parts[4] AS email,
       parts[5] AS phone, parts[6] AS country, parts[7] AS segment, parts[8] AS registration_date
FROM u_split WHERE coalesce(len(parts) = 8, false)""")
U_NORM = ("u_norm", f"""
SELECT _seq, user_id, full_name, document_id, email, phone, country, segment, registration_date,
  CASE WHEN regexp_matches(registration_date, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$')
         THEN CAST(try_strptime(registration_date, '%d/%m/%Y') AS DATE)
       WHEN regexp_matches(registration_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
         THEN CAST(try_strptime(registration_date, '%Y-%m-%d') AS DATE) END AS registration_date_parsed
FROM (SELECT _seq, trim(user_id) AS user_id, trim(full_name) AS full_name,
        trim(document_id) AS document_id, lower(trim(email)) AS email, trim(phone) AS phone,
        CASE upper(trim(country))
          WHEN 'PERU' THEN 'PE' WHEN 'PER' THEN 'PE' WHEN 'CHILE' THEN 'CL' WHEN 'CHI' THEN 'CL'
          WHEN 'COLOMBIA' THEN 'CO' WHEN 'COL' THEN 'CO' WHEN 'ARGENTINA' THEN 'AR' WHEN 'ARG' THEN 'AR'
          WHEN 'MEXICO' THEN 'MX' WHEN 'MEX' THEN 'MX' ELSE upper(trim(country)) END AS country,
        lower(trim(segment)) AS segment, trim(registration_date) AS registration_date
      FROM u_fields)""")
U_PHONE = ("u_phone", """
SELECT *, phone_country_code = country AS phone_country_match FROM (
  SELECT *, regexp_matches(phone_clean, '^[0-9]{10,15}$') AS is_valid_phone_format,
    CASE WHEN starts_with(phone_clean, '51') THEN 'PE' WHEN starts_with(phone_clean, '56') THEN 'CL'
         WHEN starts_with(phone_clean, '57') THEN 'CO' WHEN starts_with(phone_clean, '54') THEN 'AR'
         WHEN starts_with(phone_clean, '52') THEN 'MX' ELSE 'UNKNOWN' END AS phone_country_code
  FROM (SELECT *, CASE WHEN NOT phone_has_letters THEN regexp_replace(phone, '[^0-9]', '', 'g') END
                  AS phone_clean
        FROM (SELECT *, regexp_matches(phone, '[A-Za-z]') AS phone_has_letters FROM u_norm)))""")
U_FLAGS = ("u_flags", r"""
SELECT *,
  regexp_matches(user_id, '^USR-[0-9]{6}$') AS is_valid_user_id,
  regexp_matches(document_id, '^[0-9]{7,9}$') AS is_valid_document_id,
  regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') AS is_valid_email,
  (NOT phone_has_letters) AND is_valid_phone_format AND phone_country_code <> 'UNKNOWN'
    AND phone_country_match AS is_valid_phone,
  country IN ('PE', 'CL', 'CO', 'AR', 'MX') AS is_valid_country,
  segment IS NULL OR segment IN ('premium', 'estandar', 'nuevo') AS is_valid_segment,
  registration_date_parsed IS NOT NULL AS is_valid_registration_date
FROM u_phone""")
U_OK = ("coalesce(is_valid_user_id AND is_valid_document_id AND is_valid_email AND is_valid_phone "
        "AND is_valid_country AND is_valid_segment AND is_valid_registration_date, false)")
U_CHAIN = (RAW_U, U_FIELDS_ALL, U_FIELDS, U_NORM, U_PHONE, U_FLAGS)
U_FLAG_NAMES = ("is_valid_user_id", "is_valid_document_id", "is_valid_email", "is_valid_phone",
                "is_valid_country", "is_valid_segment", "is_valid_registration_date")

KPIS = ("kpis", """
SELECT *, least(CAST(100 AS DOUBLE), reversal_rate * 60 + CASE WHEN reversed_amount > 50000 THEN 40
                 WHEN reversed_amount > 10000 THEN 20 ELSE 0 END) AS risk_score
FROM (SELECT *, CASE WHEN total_payments > 0 THEN total_reversals / total_payments
                     ELSE CAST(0 AS DOUBLE) END AS reversal_rate
      FROM (SELECT transaction_date, merchant_id, channel, currency,
              CAST(count(*) AS BIGINT) AS total_transactions,
              CAST(count(*) FILTER (WHERE transaction_type = 'pago') AS BIGINT) AS total_payments,
              CAST(count(*) FILTER (WHERE transaction_type = 'reversa') AS BIGINT) AS total_reversals,
              CAST(count(*) FILTER (WHERE transaction_type = 'retiro') AS BIGINT) AS total_withdrawals,
              sum(amount) AS total_amount,
              avg(amount) AS average_amount,
              sum(CASE WHEN transaction_type = 'reversa' THEN amount ELSE 0 END) AS reversed_amount,
              CAST(count(*) FILTER (WHERE status = 'rechazado') AS BIGINT) AS total_rejected_transactions
            FROM tx_clean GROUP BY transaction_date, merchant_id, channel, currency))""")

METRICS = ("metrics", """
SELECT merchant_id,
  CAST(sum(total_transactions) AS BIGINT) AS historical_transactions,
  CAST(sum(total_reversals) AS BIGINT) AS historical_reversals,
  sum(total_amount) AS historical_amount,
  round(avg(reversal_rate), 9) AS average_reversal_rate,
  max(risk_score) AS maximum_risk_score,
  CAST(count(DISTINCT transaction_date) AS BIGINT) AS active_days
FROM kpis GROUP BY merchant_id""")

ALERTS = ("alerts", """
SELECT *, concat_ws(',', CASE WHEN reversal_rate > 0.30 THEN 'high_reversal_rate' END,
                         CASE WHEN risk_score >= 60 THEN 'high_risk_score' END) AS alert_reason
FROM kpis WHERE reversal_rate > 0.30 OR risk_score >= 60""")

KEYS4 = "transaction_date, merchant_id, channel, currency"


def _quarantine_select(source: str, valid_cte: str, key: str) -> str:
    amount = "amount" if source == "transactions" else "CAST(NULL AS DOUBLE)"
    country = "country" if source == "merchants" else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{source}' AS source_name, rejection_reason, CAST(_seq AS BIGINT) AS record_seq, "
            f"{key} AS record_key, rejection_reason AS record_reason, {amount} AS record_amount, "
            f"status AS record_status, {country} AS record_country "
            f"FROM {valid_cte} WHERE rejection_reason IS NOT NULL")


Q_TX = _quarantine_select("transactions", "tx_valid", "transaction_id")
Q_M = _quarantine_select("merchants", "m_valid", "merchant_id")


def _q(ctes, select: str) -> str:
    return _with(*ctes) + "\n" + select


ORACLE_SQL: dict[str, str] = {
    "tx_parse_amount": _q([RAW_TX], f"SELECT _seq, amount AS amount_raw, {AMOUNT_SQL} AS amount FROM raw_tx"),
    "tx_fold_and_recode": _q([RAW_TX, TX_NORM],
                             "SELECT _seq, transaction_type, channel, status, currency FROM tx_norm"),
    "tx_parse_date": _q([RAW_TX], "SELECT _seq, transaction_date AS transaction_date_raw, "
                        f"{_strict_date('transaction_date', [ISO, DMY])} AS transaction_date FROM raw_tx"),
    "tx_dedup": _q([RAW_TX, TX_NORM, TX_DEDUP], "SELECT * FROM tx_dedup"),
    "tx_validated": _q(TX_CHAIN[:4], "SELECT * FROM tx_valid"),
    "tx_rejection_counts": _q(TX_CHAIN[:4], "SELECT rejection_reason, CAST(count(*) AS BIGINT) AS n_rows "
                              "FROM tx_valid GROUP BY rejection_reason"),
    "tx_clean": _q(TX_CHAIN, "SELECT * FROM tx_clean"),
    "tx_quarantine": _q(TX_CHAIN[:4], Q_TX),
    "merchants_normalized": _q([RAW_M, M_NORM], "SELECT * FROM m_norm"),
    "merchants_validated": _q(M_CHAIN[:4], "SELECT * FROM m_valid"),
    "merchants_rejection_counts": _q(M_CHAIN[:4], "SELECT rejection_reason, CAST(count(*) AS BIGINT) "
                                     "AS n_rows FROM m_valid GROUP BY rejection_reason"),
    "merchants_clean": _q(M_CHAIN, "SELECT * FROM m_clean"),
    "merchants_quarantine": _q(M_CHAIN[:4], Q_M),
    "quarantine_all": _q(TX_CHAIN[:4] + M_CHAIN[:4], f"{Q_TX}\nUNION ALL\n{Q_M}"),
    "users_structural_split": _q([RAW_U, U_FIELDS_ALL, U_FIELDS], "SELECT * FROM u_fields"),
    "users_structural_quarantine": _q(
        [RAW_U, U_FIELDS_ALL],
        "SELECT _seq, value, CAST(len(parts) AS INTEGER) AS n_parts, 'STRUCTURE_MISMATCH' AS error_type, "
        "'Invalid number of columns after split' AS error_reason FROM u_split "
        "WHERE NOT coalesce(len(parts) = 8, false)"),
    "users_normalized": _q(U_CHAIN[:4], "SELECT * FROM u_norm"),
    "users_phone": _q(U_CHAIN[:5], "SELECT _seq, phone, country, phone_has_letters, phone_clean, "
                      "is_valid_phone_format, phone_country_code, phone_country_match FROM u_phone"),
    "users_flags": _q(U_CHAIN, "SELECT * FROM u_flags"),
    "users_dq_summary": _q(U_CHAIN, """SELECT
  CAST(count(*) FILTER (WHERE NOT is_valid_user_id) AS BIGINT) AS invalid_user_id,
  CAST(count(*) FILTER (WHERE NOT is_valid_document_id) AS BIGINT) AS invalid_document_id,
  CAST(count(*) FILTER (WHERE NOT is_valid_email) AS BIGINT) AS invalid_email,
  CAST(count(*) FILTER (WHERE NOT is_valid_phone_format) AS BIGINT) AS invalid_phone,
  CAST(count(*) FILTER (WHERE NOT is_valid_country) AS BIGINT) AS invalid_country,
  CAST(count(*) FILTER (WHERE NOT is_valid_segment) AS BIGINT) AS invalid_segment,
  CAST(count(*) FILTER (WHERE NOT is_valid_registration_date) AS BIGINT) AS invalid_registration_date
FROM u_flags"""),
    "users_clean": _q(U_CHAIN, f"SELECT * FROM u_flags WHERE {U_OK}"),
    "users_quarantine": _q(U_CHAIN, "SELECT *, 'DATA_QUALITY_ERROR' AS error_type, concat_ws(',', "
                           + ", ".join(f"CASE WHEN NOT coalesce({f}, false) THEN '{f}' END"
                                       for f in U_FLAG_NAMES)
                           + f") AS error_reason FROM u_flags WHERE NOT {U_OK}"),
    "users_row_counts": _q(U_CHAIN, f"""SELECT
  (SELECT CAST(count(*) AS BIGINT) FROM raw_u) AS total_lines,
  (SELECT CAST(count(*) AS BIGINT) FROM u_fields) AS structurally_valid,
  (SELECT CAST(count(*) AS BIGINT) FROM raw_u) - (SELECT CAST(count(*) AS BIGINT) FROM u_fields)
    AS structure_rejects,
  (SELECT CAST(count(*) AS BIGINT) FROM u_flags WHERE {U_OK}) AS clean,
  (SELECT CAST(count(*) AS BIGINT) FROM u_flags WHERE NOT {U_OK}) AS quarantined"""),
    "users_invalid_email": _q(U_CHAIN, "SELECT email FROM u_flags WHERE is_valid_email = false"),
    "users_invalid_phone_report": _q(
        U_CHAIN, "SELECT phone, phone_clean, country, phone_country_code, "
        "CAST(length(phone_clean) AS INTEGER) AS phone_length FROM u_flags "
        "WHERE is_valid_phone = false ORDER BY country, phone_length"),
    "gold_daily_kpis": _q(TX_CHAIN + (KPIS,), "SELECT * FROM kpis"),
    "gold_conditional_counts": _q(TX_CHAIN + (KPIS,), f"SELECT {KEYS4}, total_payments, total_reversals, "
                                  "total_withdrawals, total_rejected_transactions, reversed_amount FROM kpis"),
    "gold_reversal_rate": _q(TX_CHAIN + (KPIS,), f"SELECT {KEYS4}, total_payments, total_reversals, "
                             "reversal_rate FROM kpis"),
    "gold_risk_score": _q(TX_CHAIN + (KPIS,), f"SELECT {KEYS4}, reversal_rate, reversed_amount, risk_score "
                          "FROM kpis"),
    "gold_merchant_metrics": _q(TX_CHAIN + (KPIS, METRICS), "SELECT * FROM metrics"),
    "gold_merchant_risk_summary": _q(TX_CHAIN + M_CHAIN + (KPIS, METRICS),
                                     "SELECT * FROM m_clean LEFT JOIN metrics USING (merchant_id)"),
    "gold_fraud_alerts": _q(TX_CHAIN + (KPIS, ALERTS), "SELECT * FROM alerts"),
    "gold_alert_reason_counts": _q(TX_CHAIN + (KPIS, ALERTS), "SELECT alert_reason, "
                                   "CAST(count(*) AS BIGINT) AS n_alerts FROM alerts GROUP BY alert_reason"),
}

# --- streaming flows: the staged files must reproduce the fixture rows ----------------------
TX_COLS = ("transaction_id, user_id, merchant_id, amount, transaction_type, channel, status, "
           "currency, transaction_date, reference_id")
NO_RESCUE = "CAST(NULL AS VARCHAR) AS _rescued_data"

ORACLE_SQL.update({
    "kpis_partitioned_roundtrip": ORACLE_SQL["gold_daily_kpis"],
    "ingest_json_stream": _q([RAW_TX], f"SELECT *, {NO_RESCUE} FROM raw_tx"),
    "ingest_parquet_stream": _q([RAW_TX], f"SELECT *, {NO_RESCUE} FROM raw_tx"),
    # CSV inference types the small sequence numbers as int.
    "ingest_csv_stream": _q([RAW_M], "SELECT CAST(_seq AS INTEGER) AS _seq, merchant_id, merchant_name, "
                            "category, country, affiliation_date, status, risk_level, "
                            f"{NO_RESCUE} FROM raw_m"),
    "ingest_text_stream": _q([RAW_U], f"SELECT value, {NO_RESCUE} FROM raw_u"),
    "ingest_source_file_lineage": _q([RAW_U], "SELECT CAST(count(*) AS BIGINT) AS n_rows, "
                                     "CAST(count(*) AS BIGINT) AS n_with_source_file, "
                                     "CAST(count(*) AS BIGINT) AS n_txt_files FROM raw_u"),
    "ingest_schema_evolution": _q([RAW_TX], "SELECT *, CASE WHEN _seq >= 1000000000 "
                                  f"THEN upper(trim(channel)) END AS device, {NO_RESCUE} FROM raw_tx"),
    "ingest_rescued_data": _q([RAW_TX], "SELECT CASE WHEN _seq < 1000000000 THEN _seq END AS _seq, "
                              f"{TX_COLS}, CASE WHEN _seq >= 1000000000 THEN "
                              "'{\"_seq\":\"#' || CAST(_seq AS VARCHAR) || '\"}' END AS _rescued_data "
                              "FROM raw_tx"),
    "stream_dedup_across_batches": _q([RAW_TX], "SELECT DISTINCT transaction_id FROM raw_tx"),
    "stream_quarantine_fan_in": _q(TX_CHAIN[:4] + M_CHAIN[:4],
                                   "SELECT source_name, rejection_reason, record_key, record_reason "
                                   f"FROM ({Q_TX}\nUNION ALL\n{Q_M})"),
    "stream_silver_end_to_end": ORACLE_SQL["gold_daily_kpis"],
    "stream_gold_incremental": ORACLE_SQL["gold_daily_kpis"],
    "stream_gold_after_crash": ORACLE_SQL["gold_daily_kpis"],
    "stream_after_full_refresh": ORACLE_SQL["gold_daily_kpis"],
    "ingest_csv_two_date_formats": _q(M_CHAIN[:4], "SELECT * FROM m_valid"),
    "ingest_rescued_nested": _q([RAW_TX], "SELECT _seq, transaction_id, "
                                "CASE WHEN _seq < 1000000000 THEN _seq END AS detail_n, "
                                "CASE WHEN _seq >= 1000000000 THEN '#' || CAST(_seq AS VARCHAR) "
                                "END AS rescued_n FROM raw_tx"),
    "ingest_late_column": _q([RAW_TX], "SELECT *, CASE WHEN _seq >= 1000000000 "
                             f"THEN upper(trim(channel)) END AS device, {NO_RESCUE} FROM raw_tx"),
    "ingest_csv_mixed_headers": _q([RAW_M], "SELECT CAST(_seq AS INTEGER) AS _seq, merchant_id, "
                                   "merchant_name, category, country, affiliation_date, status, "
                                   "risk_level, CASE WHEN _seq < 1000000000 AND _seq % 3 = 2 THEN "
                                   "lpad(CAST(_seq AS VARCHAR), 9, '0') END AS code, "
                                   f"{NO_RESCUE} FROM raw_m"),
    "ingest_rescued_unknown_column": _q([RAW_TX], "SELECT *, CASE WHEN _seq >= 1000000000 THEN "
                                        "'{\"device\":\"' || upper(trim(channel)) || '\"}' END "
                                        "AS _rescued_data FROM raw_tx"),
    "ingest_rescued_malformed": _q([RAW_TX], "SELECT CASE WHEN _seq < 1000000000 THEN _seq END AS _seq, "
                                   "CASE WHEN _seq < 1000000000 THEN transaction_id END AS transaction_id, "
                                   "CASE WHEN _seq >= 1000000000 THEN '{\"_seq\":' || CAST(_seq AS VARCHAR) "
                                   "|| ',\"transac' END AS corrupt FROM raw_tx"),
    "ingest_timestamps": _q([RAW_TX], "SELECT CAST(count(*) AS BIGINT) AS n_rows, "
                            "CAST(count(*) AS BIGINT) AS n_with_time, CAST(2 AS BIGINT) AS n_times, "
                            "true AS in_order, true AS not_in_the_future FROM raw_tx"),
    "gold_processed_at": _q(TX_CHAIN + (KPIS,), "SELECT CAST(count(*) AS BIGINT) AS n_rows, "
                            "CAST(count(*) AS BIGINT) AS n_with_time, CAST(1 AS BIGINT) AS n_times, "
                            "true AS not_in_the_future FROM kpis"),
    "stream_dedup_hot_key": _q([RAW_TX], "SELECT DISTINCT CASE WHEN _seq % 3 = 0 THEN 'N/A' "
                               "ELSE transaction_id END AS transaction_id FROM raw_tx"),
    "stream_dedup_bounded": _q([RAW_TX], "SELECT DISTINCT transaction_id FROM raw_tx"),
})
