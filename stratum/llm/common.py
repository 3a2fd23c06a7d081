"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import ensure_checkpoint_dir

# The six ASCII blanks that separate words, as a regex class body.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, as a URI."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stratum-llm/{name}-{uuid.uuid4().hex[:12]}"


# Tables written since ``settled`` began, while it runs.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back (compressed, columnar).

    The table stays as long as a result may read it; see ``settled``.
    """
    spark = df.sparkSession
    uri = scratch_uri(spark, name)
    df.write.parquet(uri)
    made = _made.get()
    if made is not None:
        made.append(uri)
    return spark.read.schema(df.schema).parquet(uri)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The written result of ``make()``, whose own intermediate tables are removed then."""
    token = _made.set([])
    try:
        df = make()
        inner = _made.get() or []
        uri = scratch_uri(spark, name)
        df.write.parquet(uri)
    finally:
        _made.reset(token)
    for table in inner:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return spark.read.schema(df.schema).parquet(uri)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_tk``, ``_text`` only: extra columns cannot clash with working names.

    (_id, _tk) names a row by its id and its text's hash, so null ids and repeated
    ids join back to the right text; rows equal in both get equal results anyway.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_tk"),
                       text.alias("_text"))


def same_row(left: str, right: str) -> Column:
    """Null-safe join condition on the row key of ``keyed``."""
    return F.expr(f"{left}._tk = {right}._tk AND {left}._id <=> {right}._id")
