"""Column builders for value normalisation.

All of them return plain Catalyst expressions (no UDF), so they stay inside
whole-stage codegen and work unchanged on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(c: ColumnOrName) -> Column:
    """lower(trim(c)).  ``trim`` strips spaces only, not tabs or newlines."""
    return F.lower(F.trim(_col(c)))


def recode(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Replace values found in ``mapping``; anything else passes through.

    One map lookup (``try_element_at`` on a literal map) instead of a chain of
    rewrites that each re-read the previous one: the input expression appears
    twice in the plan, not once per alias, which keeps long pipelines inside
    whole-stage codegen.  Valid because no output of the mapping is a key.
    """
    col = _col(c)
    if not mapping:
        return col
    return F.coalesce(F.try_element_at(_map_literal(mapping), col), col)


def _map_literal(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def parse_amount(c: ColumnOrName) -> Column:
    """Locale amount text -> double (European convention).

    Dots are thousands separators only when the text holds both ',' and '.';
    then every ',' becomes the decimal point.  ``1.234,56`` -> 1234.56,
    ``12,75`` -> 12.75, ``12.25`` -> 12.25, but ``1,234.56`` -> 1.23456.
    Unparseable text gives NULL (``try_cast``), never an error.
    """
    text = _col(c).cast("string")
    both = text.contains(",") & text.contains(".")
    no_thousands = F.when(both, F.regexp_replace(text, r"\.", "")).otherwise(text)
    return F.regexp_replace(no_thousands, ",", ".").try_cast("double")


def parse_date(c: ColumnOrName, formats: Sequence[str] = ("yyyy-MM-dd", "dd/MM/yyyy")) -> Column:
    """First format that parses wins; NULL when none does (strict, no error).

    Each attempt is guarded by the format's literal separators being present
    in the text - a necessary condition for the parse to succeed, so results
    are unchanged - which skips the costly failed-parse path for rows written
    in another format.
    """
    col = _col(c)
    attempts = []
    for fmt in formats:
        parsed = F.try_to_date(col, fmt)
        literals = sorted({ch for ch in fmt if not ch.isalpha() and ch != "'"})
        if literals:
            guard = None
            for ch in literals:
                g = col.contains(ch)
                guard = g if guard is None else guard & g
            parsed = F.when(guard, parsed)
        attempts.append(parsed)
    return F.coalesce(*attempts)


def parse_date_gated(c: ColumnOrName, shapes: Sequence[tuple[str, str]]) -> Column:
    """Pick the date format by a regex shape test, then parse strictly.

    ``shapes`` is an ordered list of (regex, format).  Text matching no shape,
    or an impossible date such as 31/02, gives NULL.
    """
    col = _col(c)
    expr = None
    for pattern, fmt in shapes:
        cond = col.rlike(pattern)
        value = F.try_to_date(col, fmt)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def phone_digits(phone: ColumnOrName, has_letters: ColumnOrName) -> Column:
    """Digits of the phone, or NULL when the phone holds any letter."""
    return F.when(~_col(has_letters), F.regexp_replace(_col(phone), r"[^0-9]", ""))


def prefix_lookup(c: ColumnOrName, prefixes: Sequence[tuple[str, str]], default: str) -> Column:
    """First matching prefix gives the label; NULL input or no match -> default.

    When all prefixes have one length the lookup is a single map probe on the
    leading characters (same result: equal-length prefixes cannot overlap).
    """
    col = _col(c)
    lengths = {len(p) for p, _ in prefixes}
    if len(lengths) == 1 and len({p for p, _ in prefixes}) == len(prefixes):
        (n,) = lengths
        lead = F.when(F.length(col) >= n, F.substring(col, 1, n))
        return F.coalesce(F.try_element_at(_map_literal(dict(prefixes)), lead), F.lit(default))
    expr = None
    for prefix, label in prefixes:
        cond = col.startswith(prefix)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))
