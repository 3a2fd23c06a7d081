"""Write frames as landing files in the formats the ingest layer consumes.

Used to stage the dirty fixtures as arriving files (JSON arrays, CSV with a
header, pipe-delimited text).  All writes go through Spark's committed file
writer, so a lost executor cannot leave half a file behind.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _json_array_lines(batches):
    """Per partition: the rows' JSON documents as the lines of one JSON array."""
    import pandas as pd

    started = False
    for pdf in batches:
        if pdf.empty:
            continue
        docs = pdf["_doc"].astype(str)
        prefix = pd.Series(",", index=docs.index)
        if not started:
            prefix.iloc[0] = "["
            started = True
        yield pd.DataFrame({"value": prefix + docs})
    if started:
        yield pd.DataFrame({"value": ["]"]})


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 50_000,
                      mode: str = "append") -> None:
    """One JSON array document per file, about ``rows_per_file`` rows each.

    Rows are spread round-robin over ``ceil(n / rows_per_file)`` partitions;
    each partition streams out as one file ``[doc\n,doc\n...\n]`` (the array
    spans lines, which a multi-line JSON reader accepts).  The JSON itself is
    produced JVM-side; the Arrow-batched Python step only adds the brackets and
    commas, batch by batch, so no partition is ever held in memory.
    """
    n = df.count()
    n_files = max(1, math.ceil(n / rows_per_file))
    docs = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("_doc"))
    (docs.repartition(n_files).mapInPandas(_json_array_lines, "value string")
     .write.mode(mode).text(path))


def write_csv(df: DataFrame, path: str, mode: str = "append", n_files: int | None = None) -> None:
    """CSV with a header; leading/trailing blanks are kept (they are data)."""
    out = df.repartition(n_files) if n_files else df
    (out.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "append",
               n_files: int | None = None) -> None:
    out = df.select(column)
    out = out.repartition(n_files) if n_files else out
    out.write.mode(mode).text(path)


def write_files(df: DataFrame, path: str, file_format: str, **kw) -> None:
    if file_format == "json":
        write_json_arrays(df, path, **kw)
    elif file_format == "csv":
        write_csv(df, path, **kw)
    elif file_format == "text":
        write_text(df, path, **kw)
    else:
        df.write.mode(kw.get("mode", "append")).format(file_format).save(path)
