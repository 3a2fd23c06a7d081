"""Which keys occur more than once, told back to the rows that hold them.

Tasks emit rows (key, who holds it, what to report).  A key that occurs twice within
one Arrow batch is settled there: its holders are "known" and need no partner, and
one witness row tells the other tasks.  So a key reaches its partition at most once
per batch and row, and one that a third of all documents share is no larger there
than the number of batches.  The rest is a count over a window on the key, which
sorts and spills in the JVM.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SINGLE, KNOWN, WITNESS = 0, 1, 2


def rows_schema(id_type: str) -> str:
    return (f"_key long, _key2 int, _kind byte, _id {id_type}, _tk long, _at long, _n int")


def emit(ids: pa.Array, tks: pa.Array, key: np.ndarray, key2: np.ndarray, row: np.ndarray,
         at: np.ndarray, runs: bool) -> pa.RecordBatch:
    """Rows for the keys of one batch; ``at``: what to report (a position or the key).

    ``runs``: known positions of one text that follow each other become one row.
    """
    order = np.lexsort((key2, key))
    k, k2 = key[order], key2[order]
    n = len(k)
    same = np.zeros(n + 1, bool)
    if n > 1:
        same[1:n] = (k[1:] == k[:-1]) & (k2[1:] == k2[:-1])
    many = same[:n] | same[1:]           # shares its key with a neighbour
    head = many & ~same[:n]              # first of such a group: the witness
    one = order[~many]
    known = np.sort(order[many])         # input order: by text, then position
    krow, kat = row[known], at[known]
    kn = np.ones(len(known), np.int32)
    if runs and len(known):
        new = np.ones(len(known), bool)
        new[1:] = (krow[1:] != krow[:-1]) | (kat[1:] != kat[:-1] + 1)
        first = np.flatnonzero(new)
        kn = np.diff(np.append(first, len(known))).astype(np.int32)
        krow, kat = krow[first], kat[first]
    elif len(known):
        pair = np.unique(np.stack([krow, kat]), axis=1)
        krow, kat, kn = pair[0], pair[1], np.ones(pair.shape[1], np.int32)
    w = order[head]
    count = [len(one), len(krow), len(w)]
    take = pa.array(np.concatenate([row[one], krow, np.zeros(len(w), np.int64)]),
                    mask=np.repeat([False, False, True], count))
    spread = (kat * 0x9E3779B9 + krow * 0x85EBCA6B + 1).astype(np.int64)  # known rows: anywhere
    cols = [
        pa.array(np.concatenate([key[one].view(np.int64), spread, key[w].view(np.int64)])),
        pa.array(np.concatenate([key2[one], np.zeros(len(krow), np.int32), key2[w]])),
        pa.array(np.repeat([SINGLE, KNOWN, WITNESS], count).astype(np.int8)),
        ids.take(take), tks.take(take),
        pa.array(np.concatenate([at[one], kat, np.zeros(len(w), np.int64)])),
        pa.array(np.concatenate([np.ones(len(one), np.int32), kn, np.zeros(len(w), np.int32)])),
    ]
    return pa.RecordBatch.from_arrays(cols, ["_key", "_key2", "_kind", "_id", "_tk", "_at", "_n"])


def repeated_rows(rows: DataFrame) -> DataFrame:
    """``_id``, ``_tk``, ``_at``, ``_n``: what holders of repeated keys report."""
    weight = F.expr(f"CASE _kind WHEN {SINGLE} THEN 1 WHEN {WITNESS} THEN 2 ELSE 0 END")
    seen = rows.withColumn("_seen", F.sum(weight).over(Window.partitionBy("_key", "_key2")))
    return seen.where(f"_kind = {KNOWN} OR (_kind = {SINGLE} AND _seen > 1)").select(
        "_id", "_tk", "_at", "_n")


def per_holder(rows: DataFrame) -> DataFrame:
    """``_id``, ``_tk``, ``_found``: the (at, n) of each holder."""
    return rows.groupBy("_id", "_tk").agg(F.collect_list(F.struct("_at", "_n")).alias("_found"))


def repeated(rows: DataFrame) -> DataFrame:
    return per_holder(repeated_rows(rows))


def marks(found: pa.ListArray, i: int, n: int, width: int) -> np.ndarray:
    """Positions below ``n`` covered by the windows of row ``i`` of ``_found``."""
    lo, hi = found.offsets[i].as_py(), found.offsets[i + 1].as_py()
    flat = found.values.slice(lo, hi - lo)
    at = flat.field("_at").to_numpy(zero_copy_only=False)
    run = flat.field("_n").to_numpy(zero_copy_only=False)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, np.minimum(at + run - 1 + width, n), -1)
    return np.cumsum(step[:n]) > 0
