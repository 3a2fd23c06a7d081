"""Layered tables: namespaces, storage paths, declared targets, properties, writes.

Each table ``<layer>.<name>`` is a directory of Parquet files under the
pipeline's storage root, registered in the session catalog as an external
table so it can be read with ``spark.read.table`` / ``spark.readStream.table``
or by path.  Streaming tables are written by the file sink (its
``_spark_metadata`` log gives exactly-once appends); materialised views are
overwritten as a whole.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Layout:
    """Where tables and stream checkpoints live (a shared folder on a cluster)."""
    root: str

    def table_path(self, name: str) -> str:
        layer, table = split_name(name)
        return os.path.join(self.root, "tables", layer, table)

    def checkpoint(self, flow: str) -> str:
        return os.path.join(self.root, "checkpoints", flow)

    def schema_location(self, source: str) -> str:
        return os.path.join(self.root, "schemas", source)


def split_name(name: str) -> tuple[str, str]:
    if "." not in name:
        raise ValueError(f"table name must be <layer>.<table>, got {name!r}")
    layer, table = name.split(".", 1)
    return layer, table


def ensure_namespaces(spark: SparkSession, layers=LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def _props_sql(properties: dict | None) -> str:
    if not properties:
        return ""
    body = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    return f" TBLPROPERTIES ({body})"


def _comment_sql(comment: str | None) -> str:
    return "" if not comment else " COMMENT '" + comment.replace("'", "\\'") + "'"


def declare_table(spark: SparkSession, layout: Layout, name: str, schema_ddl: str,
                  comment: str | None = None, properties: dict | None = None) -> str:
    """Create an empty table with a declared schema; one that exists must have that schema."""
    path = layout.table_path(name)
    if spark.catalog.tableExists(name):
        require_schema(name, schema_ddl, spark.table(name).schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet "
              f"LOCATION '{path}'{_comment_sql(comment)}{_props_sql(properties)}")
    return path


def require_schema(name: str, declared: T.StructType | str, actual: T.StructType) -> None:
    """Refuse a flow whose rows are not what its target declares: by name and type,
    whatever the order and nullability."""
    if isinstance(declared, str):
        declared = T._parse_datatype_string(declared)
    want = {f.name.lower(): f for f in declared.fields}
    have = {f.name.lower(): f for f in actual.fields}
    wrong = [f"{have[k].name} is not declared" for k in have if k not in want]
    wrong += [f"{want[k].name} is missing" for k in want if k not in have]
    wrong += [f"{have[k].name} is {have[k].dataType.simpleString()}, declared "
              f"{want[k].dataType.simpleString()}" for k in have
              if k in want and have[k].dataType.simpleString() != want[k].dataType.simpleString()]
    if wrong:
        raise ValueError(f"the flow into {name} does not fit its declared schema: "
                         + "; ".join(wrong))


def register(spark: SparkSession, layout: Layout, name: str, schema: T.StructType,
             comment: str | None = None, properties: dict | None = None,
             partition_by: tuple[str, ...] = ()) -> None:
    """Register the external table once, with its known schema (no file is opened).

    A later, wider schema adds its columns in place, so readers always find the
    table; it is re-created only if it was registered over other files.
    """
    path = layout.table_path(name)
    ensure_namespaces(spark, [split_name(name)[0]])
    if spark.catalog.tableExists(name) and _location(spark, name) != _plain(path):
        spark.sql(f"DROP TABLE {name}")  # metadata only: the table is external
    if not spark.catalog.tableExists(name):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{parts} "
                  f"LOCATION '{path}'{_comment_sql(comment)}{_props_sql(properties)}")
    else:
        have = {c.lower() for c in spark.table(name).columns}
        new = [f for f in schema.fields if f.name.lower() not in have]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ("
                      + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        spark.catalog.refreshTable(name)
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _plain(path: str) -> str:
    return re.sub(r"^file:/*", "/", path).replace("//", "/").rstrip("/")


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return _plain(rows[0].data_type) if rows else ""


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """Batch read; ``mergeSchema`` unions the column sets of evolved files."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def stream_path(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Incremental read of a table (by a file sink's commit log where there is one).

    Every file counts once, by name and whatever its age."""
    schema = schema or read_path(spark, path).schema
    return spark.readStream.option("maxFileAge", "36500d").schema(schema).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Materialised view: replace the whole table (idempotent on retry)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_partitioned(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read a partitioned table back with its original column order."""
    return spark.read.parquet(path).select(*columns)
