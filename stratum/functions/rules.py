"""Rule chains and validity flags as single Catalyst expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[Column, str]


def first_failure(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule whose condition is TRUE, else NULL.

    Conditions follow SQL three-valued logic: a NULL condition does not fire,
    so e.g. ``NOT (x IN (...))`` lets a NULL ``x`` through, as in the source
    pipeline.  One reason per row; order is the contract.
    """
    if not rules:
        return F.lit(None).cast("string")
    expr = None
    for cond, reason in rules:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def all_true(flags: Sequence[Column]) -> Column:
    """Total conjunction: TRUE only when every flag is TRUE (NULL counts as false)."""
    return F.coalesce(reduce(lambda a, b: a & b, flags), F.lit(False))


def failed_names(flags: Mapping[str, Column]) -> Column:
    """Comma-joined names of the flags that are not TRUE."""
    return F.concat_ws(",", *[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in flags.items()])
