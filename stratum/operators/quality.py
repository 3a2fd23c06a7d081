"""Valid / rejected splits, quarantine envelopes and data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.rules import all_true, failed_names

REASON = "rejection_reason"

# Columns of the shared quarantine table.
QUARANTINE_SCHEMA = ("source_name STRING, rejection_reason STRING, "
                     "original_record STRING, processed_at TIMESTAMP")


def valid_rows(validated: DataFrame, reason: str = REASON) -> DataFrame:
    """Rows with no rejection reason, without the reason column."""
    return validated.filter(F.col(reason).isNull()).drop(reason)


def rejected_rows(validated: DataFrame, reason: str = REASON) -> DataFrame:
    return validated.filter(F.col(reason).isNotNull())


def quarantine_envelope(rejected: DataFrame, source_name: str, reason: str = REASON) -> DataFrame:
    """(source_name, rejection_reason, original_record, processed_at).

    ``original_record`` is the JSON of the whole *normalised* row, reason
    included; NULL fields are omitted by ``to_json``.
    """
    return rejected.select(
        F.lit(source_name).alias("source_name"),
        F.col(reason).alias("rejection_reason"),
        F.to_json(F.struct(*[F.col(c) for c in rejected.columns])).alias("original_record"),
        F.current_timestamp().alias("processed_at"),
    )


def split_fields(df: DataFrame, names: Sequence[str], source: str = "value", sep: str = "|",
                 keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split a delimited text column into named string fields.

    Returns (ok, bad).  ``ok`` holds rows with exactly ``len(names)`` fields
    (empty fields are ``''``, trailing ones included), projected to ``keep`` +
    ``names``.  ``bad`` holds every other row - including a NULL line, which a
    plain ``size(...) != n`` test would silently lose - with the ``parts``
    array.  ``ok`` and ``bad`` partition the input exactly.
    """
    n = len(names)
    parts = F.split(F.col(source), _regex_literal(sep), -1)
    framed = df.withColumn("parts", parts)
    ok_pred = F.coalesce(F.size("parts") == n, F.lit(False))
    ok = framed.filter(ok_pred).select(
        *[F.col(k) for k in keep],
        *[F.get(F.col("parts"), i).alias(name) for i, name in enumerate(names)])
    bad = framed.filter(~ok_pred)
    return ok, bad


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)


def structural_quarantine(bad: DataFrame, error_type: str, error_reason: str) -> DataFrame:
    return bad.withColumns({
        "error_type": F.lit(error_type),
        "error_reason": F.lit(error_reason),
        "_quarantine_timestamp": F.current_timestamp(),
    })


def flag_split(flagged: DataFrame, flags: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine): clean has every flag TRUE; quarantine is the exact rest."""
    ok = all_true([F.col(f) for f in flags])
    return flagged.filter(ok), flagged.filter(~ok)


def flag_quarantine(quarantined: DataFrame, flags: Sequence[str], error_type: str) -> DataFrame:
    """Tag rule rejects with an error type and the names of the failed checks."""
    return quarantined.withColumns({
        "error_type": F.lit(error_type),
        "error_reason": failed_names({f: F.col(f) for f in flags}),
        "_quarantine_timestamp": F.current_timestamp(),
    })


def dq_summary(flagged: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """One row: per output name, the number of rows whose flag is FALSE.

    NULL flags are not counted (``count_if`` of a NULL predicate).  A single
    global aggregate: partial counts per task, one tiny final merge.
    """
    return flagged.agg(*[F.count_if(~F.col(flag)).alias(out) for out, flag in flags.items()])

