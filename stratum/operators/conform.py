"""Give a frame the columns a plan consumes, even when the files never held them.

Schema inference only sees columns that occur in the data: a column that is
NULL in every row of a JSON delivery is omitted by the writer and therefore
missing from the inferred schema.  Plans declare the raw columns they read;
absent ones are added as typed NULLs (never dropped or renamed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ensure_columns(df: DataFrame, names: Sequence[str], dtype: str = "string") -> DataFrame:
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if not missing:
        return df
    return df.withColumns({n: F.lit(None).cast(dtype) for n in missing})
