"""Exact top-k by inner product with no-random-access aggregation (NRA).

Candidates are dealt into blocks of bounded size and queries into blocks as well; a
task gets one pair of blocks.  In a block every dimension is a list sorted by value,
read in step for all queries at once, from the end that the sign of a query's
component makes the best one.  What was read gives every candidate a lower bound
(unread components at the worst end of their list) and an upper bound (unread ones
at the list's current value): both are products of the queries with a matrix of the
values read so far and the two kinds of stand-ins.  A candidate whose upper bound is
below the k-th best lower bound is out; reading stops for a query when few are left, or
when the lists are read.  The scores of those are resolved in integers, ties going to
the smaller id.  The best k of every block meet in one ranked window, which Spark limits to
k per task before its shuffle.

Bounds are doubles with a slack for their rounding, so they never exclude a row that
belongs; what is resolved is exact: products of doubles below 2^53, Python's integers
beyond.

Each candidate block is sent once per query block: the stated query set against all
rows, in blocks.  Memory per task: two blocks, and ``TILE`` queries' bounds at a time.
A vector that a third of all rows hold spreads over the blocks, since rows are dealt
round-robin.

Defined results: components become ``floor(scale * x)``; a vector that is null, empty
or holds a null or non-finite component takes no part, nor does a null id; vectors
are compared with those of their own length; every row whose id is a multiple of
``every`` is a query, against every row but itself (rows that share its id are
candidates); a score beyond a long is null, its row keeps its rank; a component beyond
2^56 after scaling is an error; fewer candidates than k give fewer rows; an empty
table gives none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import written

EXACT = 2.0 ** 53       # products below are exact in doubles
STEPS = (1 / 16, 1 / 4, 1 / 2, 1)
FEW = 8                 # stop reading when at most FEW * k candidates are left
TILE = 256              # queries whose bounds are held at once


class Block:
    """Sorted lists of one candidate block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.exact = rows, ids, vectors
        self.x = vectors.astype(float)
        order = np.argsort(self.x, axis=0, kind="stable")
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(ids))[:, None], axis=0)
        self.lists = np.take_along_axis(self.x, order, axis=0)          # ascending

    def bounds(self, depth: int) -> tuple[np.ndarray, ...]:
        """The values read at ``depth``, the unread ones replaced by the list's worst and
        current value; from the large end (for components above 0) and the small one."""
        n = len(self.ids)
        if depth >= n:
            return self.x, self.x, self.x, self.x
        top, bottom = self.rank >= n - depth, self.rank < depth
        return (np.where(top, self.x, self.lists[0]), np.where(top, self.x, self.lists[n - depth]),
                np.where(bottom, self.x, self.lists[-1]), np.where(bottom, self.x, self.lists[depth - 1]))

    def top(self, queries: np.ndarray, own: np.ndarray, k: int):
        """Per query: (places, exact scores) of the best k rows other than its own."""
        for lo in range(0, len(queries), TILE):
            q = queries[lo:lo + TILE]
            alive = self.rows[None, :] != own[lo:lo + TILE, None]
            self._narrow(q.astype(float), alive, k)
            for v, left in zip(q, alive):
                at = np.flatnonzero(left)
                scores = self._scores(at, v)
                best = np.lexsort((self.ids[at], -scores))[:k]
                yield at[best], scores[best]

    def _scores(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.empty(0)
        x = self.x[at]
        size = float((np.abs(x).max(axis=0) * np.abs(v.astype(float))).sum())
        if size < EXACT:
            return x @ v.astype(float)
        return np.array([sum(int(a) * int(b) for a, b in zip(r, v)) for r in self.exact[at]],
                        object)

    def _narrow(self, q: np.ndarray, alive: np.ndarray, k: int) -> None:
        """Read the lists step by step; clear ``alive`` where a row cannot be among the best."""
        n = len(self.ids)
        up, down = np.maximum(q, 0.0), np.minimum(q, 0.0)
        slack = (np.abs(q) @ np.abs(self.x).max(axis=0)) * 2.0 ** -40
        reading = np.flatnonzero(alive.sum(axis=1) > FEW * k)
        read = 0
        for part in STEPS:
            depth = min(n, max(k, int(n * part)))
            if depth <= read or not len(reading):
                continue
            read = depth
            low_up, high_up, low_down, high_down = self.bounds(depth)
            u, d = up[reading], down[reading]
            low = u @ low_up.T + d @ low_down.T
            high = low if depth == n else u @ high_up.T + d @ high_down.T
            low = np.where(alive[reading], low, -np.inf)
            kth = np.partition(low, n - k, axis=1)[:, n - k]
            alive[reading] &= high >= (kth - slack[reading])[:, None]
            reading = reading[alive[reading].sum(axis=1) > FEW * k]


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """_row, _id, _v, _d of the vectors that take part, written: a row number names a row."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    whole = lambda v: F.floor(v * F.lit(float(scale)))
    fits = lambda v: F.when(F.abs(v * F.lit(float(scale))) < F.lit(2.0 ** 56), whole(v)).otherwise(
        F.raise_error(F.lit(f"a component of {vector_col} is beyond 2^56 after scaling")).cast("long"))
    good = rows.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & (F.size(x) > 0)
                      & ~F.exists(x, odd))
    return written(good.select(
        F.monotonically_increasing_id().alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.transform(x, fits).alias("_v"), F.size(x).alias("_d")), "topk-vectors")


def top_k(rows: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: float = 1024.0, block_rows: int = 4096,
          query_rows: int = 16384) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of each query row (id % every = 0)."""
    vectors = integer_vectors(rows, id_col, vector_col, scale)
    asking = vectors.where(F.col("_id") % every == 0)
    n, m = vectors.count(), asking.count()
    across, down = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    block = lambda parts: F.pmod(F.xxhash64("_row"), F.lit(parts))
    cand = vectors.withColumn("_c", block(across)).withColumn(
        "_q", F.explode(F.expr(f"sequence(0L, {down - 1}L)")))
    # Names of their own: both sides come from one table.
    ask = asking.select(
        F.col("_row").alias("_own"), F.col("_id").alias("_asked"), F.col("_v").alias("_qv"),
        block(down).alias("_qq"), F.explode(F.expr(f"sequence(0L, {across - 1}L)")).alias("_qc"),
        F.col("_d").alias("_qd"))
    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own, asked, found, scored = [], [], [], []
        if len(left) and len(right):
            rows = Block(left["_row"].to_numpy(np.int64), left["_id"].to_numpy(np.int64),
                         np.stack(left["_v"].to_numpy()))
            queries, mine = np.stack(right["_qv"].to_numpy()), right["_own"].to_numpy(np.int64)
            for r, i, (at, scores) in zip(mine, right["_asked"], rows.top(queries, mine, k)):
                own += [r] * len(at)
                asked += [i] * len(at)
                found += rows.ids[at].tolist()
                scored += [str(int(x)) for x in scores]
        return pd.DataFrame({"_query": np.array(own, np.int64), "query_id": np.array(asked, np.int64),
                             "vec_id": np.array(found, np.int64),
                             "score": pd.Series(scored, dtype=object)})

    hits = cand.groupBy("_c", "_q", "_d").cogroup(ask.groupBy("_qc", "_qq", "_qd")).applyInPandas(
        search, "_query long, query_id long, vec_id long, score string")
    hits = hits.withColumn("score", F.col("score").cast("decimal(38,0)"))
    rank = F.row_number().over(Window.partitionBy("_query").orderBy(
        F.col("score").desc(), F.col("vec_id")))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.col("score").try_cast("long").alias("score"))
