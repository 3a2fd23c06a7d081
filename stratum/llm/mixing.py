"""Mixing sources to target weights.

Tokens are aggregated per source, the targets give each source a repetition rate,
and every document is emitted ``floor(rate)`` times plus one Bernoulli copy whose
coin is a hash of the seed, the id, the text and the number among equal rows, so reruns
and retried tasks agree, and rows that share an id (or lack one) have coins of their own.

Targets are water-filled: every source asks for ``level * weight`` and gets at most
``max_repeat`` times its own size; the level is the one at which the targets sum to
the whole corpus (so what a full source leaves is reshared by weight).

Scale: one pre-aggregated shuffle on the source (map-side sums, so a source with a
third of the rows arrives as one row per task), then rounds of two-number
aggregates over the per-source table.  A round closes at least one source, in
practice nearly all of those that will ever close; the loop carries two numbers.
Equal rows are looked for by a pre-aggregated count of (id, text hash); where there are
some, they are numbered by task (``equal_row_numbers``).
Documents meet their source's rate in a join whose small side is one row per
source; beyond the broadcast threshold AQE splits the hot source's partition.

Defined results: a null text has size 0; null source is a source of its own and
comes last in the weight order; size-0 sources have target 0; an empty table gives
no rows; rows equal in id and text are numbered and draw a coin each; all columns pass
through ``mix`` untouched, and the number of a copy is in ``copy`` (with underscores
added while the input has a column of that name); ``plan_mix`` replaces input columns
named like its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import WORD, written

COIN_BITS = 52  # a coin is the first 13 hex digits of an MD5
PLAN = ("_size", "_ssize", "_target", "_rate", "_copies")


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: float) -> DataFrame:
    """``sizes`` (_source, _size) per document -> one row per source with its target.

    The rank that picks a weight is a distributed sort plus an index (no single-task
    window): the number of sources may be large.
    """
    spark = sizes.sparkSession
    per = sizes.groupBy("_source").agg(F.sum("_size").alias("_ssize"))
    ordered = per.orderBy(F.col("_source").asc_nulls_last())
    schema = "_source string, _ssize long, _rank long"
    ranked = spark.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])), schema)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked.withColumn("_w", weight), "mix-sources")
    total = ranked.agg(F.sum("_ssize")).first()[0] or 0
    cap = F.col("_ssize") * F.lit(float(max_repeat))

    # level = (total - what full sources take) / (weights of the others), until no
    # other source would pass its cap.
    level = 0.0
    full = F.lit(False)
    n_full = -1
    while True:
        row = ranked.agg(F.sum(F.when(full, cap).otherwise(F.lit(0.0))),
                         F.sum(F.when(~full, F.col("_w")).otherwise(F.lit(0.0))),
                         F.sum(full.cast("long"))).first()
        taken, open_weight, closed = row[0] or 0.0, row[1] or 0.0, row[2] or 0
        if closed == n_full or open_weight <= 0:
            break
        n_full = closed
        level = max(level, (total - taken) / open_weight)
        full = F.col("_w") * F.lit(level) >= cap
    target = F.least(cap, F.col("_w") * F.lit(level))
    return ranked.select("_source", "_ssize", target.alias("_target"),
                         F.when(F.col("_ssize") > 0, target / F.col("_ssize"))
                         .otherwise(F.lit(0.0)).alias("_rate"))


def coin(seed: int, *cols: Column) -> Column:
    """Uniform in [0, 1) from an MD5 of the seed and the columns (also plain SQL)."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null"))
                                               for c in cols])
    return F.conv(F.substring(F.md5(key), 1, COIN_BITS // 4), 16, 10).cast("long") / float(
        1 << COIN_BITS)


def equal_row_numbers(rows: DataFrame) -> DataFrame:
    """``rows`` (``_row``, ``_id``, ``_tk``) plus ``_number``: 0, 1, ... among equal (id, text).

    Rows are numbered only if some are equal.  A task's rows of one group are numbered
    by themselves and start behind those of the tasks before, so a group that holds a third
    of all rows is split by task; which of equal rows gets which number does not matter.
    """
    group = ["_id", "_tk"]
    if not rows.groupBy(*group).count().where("count > 1").head(1):
        return rows.withColumn("_number", F.lit(0).cast("long"))
    placed = written(rows.withColumn("_place", F.monotonically_increasing_id()), "mix-rows")
    part = F.shiftright("_place", 33).alias("_part")
    keys = placed.select(*group, "_place", part)
    tasks = keys.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1))                # one row per task and group
    many = F.sum("_n").over(Window.partitionBy(*group))
    tasks = tasks.withColumns({"_before": F.coalesce(before, F.lit(0)), "_many": many}).where(
        "_many > 1")
    local = F.row_number().over(Window.partitionBy(*group, "_part").orderBy("_place"))
    numbers = keys.withColumn("_local", local).alias("k").join(
        tasks.alias("t"), F.expr("k._id <=> t._id AND k._tk = t._tk AND k._part = t._part")).select(
        "k._place", (F.col("t._before") + F.col("k._local") - 1).alias("_number"))
    return placed.join(numbers, "_place", "left").withColumn(
        "_number", F.coalesce("_number", F.lit(0).cast("long"))).drop("_place")


def _planned(docs: DataFrame, weights: Sequence[float], max_repeat: float, seed: int, id_col: str,
             text_col: str, source_col: str) -> DataFrame:
    """``_row`` (the whole input row) and the plan's columns."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(f"`{id_col}`").cast("string").alias("_id"), F.md5(text).alias("_tk"),
                       F.col(f"`{source_col}`").cast("string").alias("_source"),
                       word_count(text_col).alias("_size"))
    targets = source_targets(rows.select("_source", "_size"), weights, max_repeat).alias("t")
    joined = equal_row_numbers(rows).alias("d").join(targets, F.expr("d._source <=> t._source"), "left")
    rate = F.col("t._rate")
    whole = F.floor(rate)
    extra = (coin(seed, F.col("d._id"), F.col("d._tk"), F.col("d._number")) < rate - whole).cast("long")
    return joined.select("d._row", "d._size", "t._ssize", "t._target", "t._rate",
                         (whole + extra).cast("long").alias("_copies"))


def plan_mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0),
             max_repeat: float = 3.0, seed: int = 17, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` plus ``_size``, ``_ssize``, ``_target``, ``_rate`` and ``_copies`` per row."""
    planned = _planned(docs, weights, max_repeat, seed, id_col, text_col, source_col)
    return planned.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in PLAN], *PLAN)


def mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), max_repeat: float = 3.0,
        seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mixed corpus: one row per emitted copy, all columns, numbered from 0 in ``copy``."""
    name = "copy"
    while name in docs.columns:
        name += "_"
    planned = _planned(docs, weights, max_repeat, seed, id_col, text_col, source_col)
    copies = planned.where("_copies > 0").select(
        "_row", F.explode(F.expr("sequence(0L, _copies - 1)")).alias("_copy"))
    return copies.select(*[F.col(f"_row.`{c}`") for c in docs.columns],
                         F.col("_copy").alias(name))
