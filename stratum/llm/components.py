"""Connected components of a link table, as rounds of joins (no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) -> ``node``, ``label``: the smallest node reachable.

    Each round every node takes the smallest label around it, then jumps to its
    label's label; star-shaped link tables settle in two or three rounds, chains in
    a logarithmic number.  A hub's links meet its one label row in a join, which
    Spark splits when skewed, and minima are pre-aggregated per task.
    """
    both = written(links.where("a <> b").select("a", "b").unionByName(
        links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.min("a")).alias("label"))
    while True:
        labels = written(labels, "labels")
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"),
                                                                       "label")
        step = labels.unionByName(near).groupBy("node").agg(F.min("label").alias("label"))
        s, t = step.alias("s"), labels.alias("t")
        jumped = s.join(t, F.expr("s.label = t.node"), "left").select(
            "s.node", F.least("s.label", F.coalesce("t.label", "s.label")).alias("label"))
        jumped = written(jumped, "labels")
        changed = jumped.alias("n").join(labels.alias("o"), F.expr("n.node = o.node")).where(
            "n.label <> o.label")
        if changed.isEmpty():
            return jumped
        labels = jumped
