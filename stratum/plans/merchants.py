"""Silver merchants: normalise -> first-seen dedup -> ordered rule chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.normalize import fold, parse_date, recode
from stratum.functions.rules import first_failure
from stratum.operators.conform import ensure_columns
from stratum.operators.dedup import dedup_first, dedup_stream
from stratum.operators.quality import REASON, quarantine_envelope, rejected_rows, valid_rows

SOURCE_NAME = "merchants"
RAW_COLUMNS = ("merchant_id", "merchant_name", "category", "country", "affiliation_date",
               "status", "risk_level")
KEY = "merchant_id"

# ---------------------------------------------------------------------------
# They must equal the source pipeline's for identical results.
# ---------------------------------------------------------------------------
STATUS_SYNONYMS = {"suspended": "suspendido"}
COUNTRY_ALIASES = {
    "peru": "PE", "per": "PE",
    "colombia": "CO", "col": "CO",
    "mexico": "MX", "mex": "MX",
    "chile": "CL", "chi": "CL",
    "argentina": "AR", "arg": "AR",
}
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
MERCHANT_ID_PATTERN = r"^MCH-\d{5}$"
CATEGORIES = ("retail", "restaurante", "farmacia", "supermercado", "tecnologia",
              "transporte", "educacion", "salud", "entretenimiento", "moda")
COUNTRIES = ("PE", "CO", "MX", "CL", "AR")
STATUSES = ("activo", "inactivo", "suspendido")
RISK_LEVELS = ("bajo", "medio", "alto")
R_ID_NULL = "merchant_id es nulo"
R_ID_FORMAT = "formato merchant_id invalido"
R_NAME = "merchant_name vacio"
R_CATEGORY = "categoria invalida"
R_COUNTRY = "pais invalido"
R_DATE = "affiliation_date invalida"
R_STATUS = "estado invalido"
R_RISK = "risk_level invalido"
# ---------------------------------------------------------------------------


def normalize(bronze: DataFrame) -> DataFrame:
    df = bronze.drop("_ingestion_timestamp")
    return df.withColumns({
        "category": fold("category"),
        "status": recode(fold("status"), STATUS_SYNONYMS),
        "risk_level": fold("risk_level"),
        "country": F.upper(recode(fold("country"), COUNTRY_ALIASES)),
        "affiliation_date": parse_date("affiliation_date", DATE_FORMATS),
    })


def rejection_reason():
    c = F.col
    return first_failure([
        (c("merchant_id").isNull(), R_ID_NULL),
        (~c("merchant_id").rlike(MERCHANT_ID_PATTERN), R_ID_FORMAT),
        (c("merchant_name").isNull() | (F.trim(c("merchant_name")) == F.lit("")), R_NAME),
        (~c("category").isin(*CATEGORIES), R_CATEGORY),
        (~c("country").isin(*COUNTRIES), R_COUNTRY),
        (c("affiliation_date").isNull(), R_DATE),
        (~c("status").isin(*STATUSES), R_STATUS),
        (c("risk_level").isNotNull() & ~c("risk_level").isin(*RISK_LEVELS), R_RISK),
    ])


def dedup(df: DataFrame, batch_order: str | None = "_seq",
          salt_buckets: int | None = None, **how) -> DataFrame:
    if df.isStreaming or batch_order is None:
        return dedup_stream(df, [KEY], salt_buckets, **how)
    return dedup_first(df, [KEY], batch_order)


def validate(bronze: DataFrame, batch_order: str | None = "_seq",
             salt_buckets: int | None = None, **how) -> DataFrame:
    """Deduplicate on the raw key, then normalise (same rows; see transactions)."""
    raw = ensure_columns(bronze, RAW_COLUMNS)
    return normalize(dedup(raw, batch_order, salt_buckets, **how)).withColumn(REASON, rejection_reason())


def clean(validated: DataFrame) -> DataFrame:
    return valid_rows(validated)


def quarantine(validated: DataFrame) -> DataFrame:
    return quarantine_envelope(rejected_rows(validated), SOURCE_NAME)
