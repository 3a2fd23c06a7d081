"""Users: delimited text -> fields -> cleansing -> validity flags -> reports.

The raw input is one ``value`` string per line with eight ``|``-separated
fields.  Everything is narrow (no shuffle) except the one-row reports, which
are single global aggregates with map-side partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.normalize import fold, parse_date_gated, phone_digits, prefix_lookup, recode
from stratum.functions.rules import all_true
from stratum.operators.quality import (dq_summary, flag_quarantine, flag_split, split_fields,
                                       structural_quarantine)

# ---------------------------------------------------------------------------
# They must equal the source pipeline's for identical results.
# ---------------------------------------------------------------------------
FIELDS = ("user_id", "full_name", "document_id", "email", "phone", "country", "segment",
          "registration_date")
SEPARATOR = "|"
STRUCTURE_ERROR_TYPE = "STRUCTURE_MISMATCH"
STRUCTURE_ERROR_REASON = "Invalid number of columns after split"
RULE_ERROR_TYPE = "DATA_QUALITY_ERROR"
COUNTRY_ALIASES = {
    "PERU": "PE", "PER": "PE",
    "CHILE": "CL", "CHI": "CL",
    "COLOMBIA": "CO", "COL": "CO",
    "ARGENTINA": "AR", "ARG": "AR",
    "MEXICO": "MX", "MEX": "MX",
}
DATE_SHAPES = (
    (r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "dd/MM/yyyy"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
)
USER_ID_PATTERN = "^USR-[0-9]{6}$"
DOCUMENT_ID_PATTERN = "^[0-9]{7,9}$"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
LETTER_PATTERN = r"[A-Za-z]"
PHONE_DIGITS_PATTERN = r"^[0-9]{10,15}$"
PHONE_PREFIXES = (("51", "PE"), ("56", "CL"), ("57", "CO"), ("54", "AR"), ("52", "MX"))
UNKNOWN_COUNTRY = "UNKNOWN"
COUNTRIES = ("PE", "CL", "CO", "AR", "MX")
SEGMENTS = ("premium", "estandar", "nuevo")
# ---------------------------------------------------------------------------

# The seven checks a clean row must pass (the phone check is the combined one).
CLEAN_FLAGS = ("is_valid_user_id", "is_valid_document_id", "is_valid_email", "is_valid_phone",
               "is_valid_country", "is_valid_segment", "is_valid_registration_date")
# The data-quality report counts the *format-only* phone check.
DQ_FLAGS = {
    "invalid_user_id": "is_valid_user_id",
    "invalid_document_id": "is_valid_document_id",
    "invalid_email": "is_valid_email",
    "invalid_phone": "is_valid_phone_format",
    "invalid_country": "is_valid_country",
    "invalid_segment": "is_valid_segment",
    "invalid_registration_date": "is_valid_registration_date",
}


def split_lines(raw: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(fields, structural quarantine) - the two partition the input lines."""
    ok, bad = split_fields(raw, FIELDS, source="value", sep=SEPARATOR, keep=keep)
    return ok, structural_quarantine(bad, STRUCTURE_ERROR_TYPE, STRUCTURE_ERROR_REASON)


def normalize(fields: DataFrame) -> DataFrame:
    c = F.col
    return fields.withColumns({
        "user_id": F.trim(c("user_id")),
        "full_name": F.trim(c("full_name")),
        "document_id": F.trim(c("document_id")),
        "email": F.lower(F.trim(c("email"))),
        "phone": F.trim(c("phone")),
        "country": recode(F.upper(F.trim(c("country"))), COUNTRY_ALIASES),
        "segment": fold("segment"),
        "registration_date": F.trim(c("registration_date")),
    }).withColumn("registration_date_parsed", parse_date_gated("registration_date", DATE_SHAPES))


def phone_columns(df: DataFrame) -> DataFrame:
    """phone_has_letters, phone_clean, is_valid_phone_format, phone_country_code,
    phone_country_match."""
    c = F.col
    return (df
            .withColumn("phone_has_letters", c("phone").rlike(LETTER_PATTERN))
            .withColumn("phone_clean", phone_digits("phone", "phone_has_letters"))
            .withColumns({
                "is_valid_phone_format": c("phone_clean").rlike(PHONE_DIGITS_PATTERN),
                "phone_country_code": prefix_lookup("phone_clean", PHONE_PREFIXES,
                                                    UNKNOWN_COUNTRY),
            })
            .withColumn("phone_country_match", c("phone_country_code") == c("country")))


def flags(normalized: DataFrame) -> DataFrame:
    """All validity flags, each evaluated independently (no short-circuit)."""
    c = F.col
    with_phone = phone_columns(normalized)
    return with_phone.withColumns({
        "is_valid_user_id": c("user_id").rlike(USER_ID_PATTERN),
        "is_valid_document_id": c("document_id").rlike(DOCUMENT_ID_PATTERN),
        "is_valid_email": c("email").rlike(EMAIL_PATTERN),
        "is_valid_phone": (~c("phone_has_letters") & c("is_valid_phone_format")
                           & (c("phone_country_code") != F.lit(UNKNOWN_COUNTRY))
                           & c("phone_country_match")),
        "is_valid_country": c("country").isin(*COUNTRIES),
        "is_valid_segment": c("segment").isNull() | c("segment").isin(*SEGMENTS),
        "is_valid_registration_date": c("registration_date_parsed").isNotNull(),
    })


def validated(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    ok, _ = split_lines(raw, keep)
    return flags(normalize(ok))


def clean_and_quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    good, bad = flag_split(flagged, CLEAN_FLAGS)
    return good, flag_quarantine(bad, CLEAN_FLAGS, RULE_ERROR_TYPE)


def summary(flagged: DataFrame) -> DataFrame:
    return dq_summary(flagged, DQ_FLAGS)


def row_counts(raw: DataFrame) -> DataFrame:
    """total / structurally valid / structural rejects / clean / rule rejects in one pass.

    Flags are evaluated on every line (they are NULL-safe), so one scan and one
    global aggregate give all counts.
    """
    parts = F.split(F.col("value"), "\\" + SEPARATOR, -1)
    framed = raw.withColumn("_parts", parts)
    struct_ok = F.coalesce(F.size("_parts") == len(FIELDS), F.lit(False))
    fields = framed.select(
        struct_ok.alias("_struct_ok"),
        *[F.when(struct_ok, F.get(F.col("_parts"), i)).alias(n) for i, n in enumerate(FIELDS)])
    flagged = flags(normalize(fields))
    ok = all_true([F.col(f) for f in CLEAN_FLAGS])
    s = F.col("_struct_ok")
    return flagged.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(s).alias("structurally_valid"),
        F.count_if(~s).alias("structure_rejects"),
        F.count_if(s & ok).alias("clean"),
        F.count_if(s & ~ok).alias("quarantined"),
    )


def invalid_email(flagged: DataFrame) -> DataFrame:
    """Drill-down: e-mails failing the check."""
    return flagged.filter(F.col("is_valid_email") == F.lit(False)).select("email")


def invalid_phone_report(flagged: DataFrame) -> DataFrame:
    """Rows failing the combined phone check, with digit count, sorted by country, length."""
    return (flagged.filter(F.col("is_valid_phone") == F.lit(False))
            .withColumn("phone_length", F.length("phone_clean"))
            .select("phone", "phone_clean", "country", "phone_country_code", "phone_length")
            .orderBy("country", "phone_length"))
