"""Append the rows of a micro-batch to a table's folder exactly once.

``foreachBatch`` may run a batch again after a crash.  So its rows are first written
to a folder of their own, then a manifest records the files, then they are moved into the
table under their names, then the batch is marked done.  A retry goes on where the last
try stopped: without a manifest it writes anew (nothing was moved yet), with one it moves
what is still there, with the mark it does nothing.  Readers see each file once, complete, and
under one name for ever; no success marker and no atomic folder rename is needed.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from stratum.sources.files import read_small_text, write_small_text
from stratum.sources.tables import delete_path, path_exists

MARKS_KEPT = 10


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Files below ``folder`` by relative path, without markers and hidden files."""
    fs, p = _fs(spark, folder)
    root = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().toUri().getPath()[len(root):]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            out.append(name)
    return sorted(out)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def append_once(df: DataFrame, path: str, state: str, batch_id: int,
                partition_by: tuple[str, ...] = ()) -> None:
    """Add ``df`` to the Parquet folder ``path`` as batch ``batch_id`` of ``state``."""
    spark = df.sparkSession
    done = f"{state}/done-{batch_id:09d}"
    staged, folder = f"{state}/staged-{batch_id:09d}", f"{state}/rows-{batch_id:09d}"
    if path_exists(spark, done):
        return
    manifest = read_small_text(spark, staged)
    if manifest is None:
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)
        manifest = json.dumps(data_files(spark, folder))
        write_small_text(spark, staged, manifest)
    names = json.loads(manifest)
    for parent in sorted({os.path.dirname(n) for n in names}):
        make_folder(spark, os.path.join(path, parent) if parent else path)

    def move(name: str) -> None:
        fs, source = _fs(spark, f"{folder}/{name}")
        target = _fs(spark, f"{path}/{name}")[1]
        if fs.exists(source):
            if not fs.rename(source, target):
                raise OSError(f"cannot publish {path}/{name}")
        elif not fs.exists(target):
            raise OSError(f"{folder}/{name} is gone and was not published")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, names))
    write_small_text(spark, done, str(len(names)))
    delete_path(spark, folder)
    delete_path(spark, staged)
    delete_path(spark, f"{state}/done-{batch_id - MARKS_KEPT:09d}")
