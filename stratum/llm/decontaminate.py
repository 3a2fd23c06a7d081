"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search.

A document leaks an item when one of its windows of the item's length has a weighted
5-word shingle similarity (sum of least / sum of greatest occurrence counts) of 0.8 or
more.  In order:

1. *Windows.* Similar texts share shingles, so windows are laid where a document and an
   item share one, at the item's own alignment.  This scan of all shingles is one join
   with the items' shingles and loses nothing: no window without a common shingle can
   be similar at all.
2. *Fingerprints.* Each window and item gets a 64-bit SimHash of its words.
3. *Multi-index search.* 64 bits are cut into radius + 1 blocks; two fingerprints
   within the radius agree on at least one block, so an equality join on (words,
   block, value) finds every pair within the radius.
4. *Verification.* The exact similarity decides.

All of it is SQL expressions; documents are read once and not shuffled.  The items'
sides are broadcast only while they are at most ``BROADCAST_ROWS`` rows, which is
counted first; beyond, Spark chooses the join (sorted and, if skewed, split).
Windows found through several shingles are pre-aggregated per task.

Words are runs of letters and digits, lower-cased.  Defined results: null, empty and
word-less documents or items match nothing; an item of fewer than five words is one
shingle, its whole sequence; a document shorter than an item is compared whole;
items with equal text each match; repeated rows and null ids keep their own rows in
``flag``; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written

NGRAM = 5
BITS, LANE = 64, 16
BROADCAST_ROWS = 1 << 17
SEPARATOR = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """Words, without the empty ones that ``split`` leaves at a separator first or last."""
    return F.array_remove(
        F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATOR), "")


def grams(words: str, size: int) -> Column:
    """Hash of every ``size`` neighbouring words, by position."""
    return F.expr(
        f"CASE WHEN size({words}) >= {size} THEN transform(sequence(0, size({words}) - {size}), "
        f"i -> xxhash64({', '.join(f'{words}[i + {k}]' for k in range(size))})) END")


def fingerprinted(df: DataFrame, words: str) -> DataFrame:
    """``df`` plus ``_fp``: the 64-bit SimHash of a bag of words, each bit by majority over
    the words' hashes.

    An aggregate over the exploded words: sixteen running sums hold four 16-bit counters
    each (windows have fewer than 65,536 words).
    """
    mask = sum(1 << (LANE * j) for j in range(BITS // LANE))
    h = F.xxhash64("_word")
    sums = [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(mask))).alias(f"_s{k}")
            for k in range(LANE)]
    counted = df.select("*", F.explode(words).alias("_word")).groupBy(*df.columns).agg(
        *sums, F.count(F.lit(1)).alias("_words"))
    out = F.lit(0).cast("long")
    for k in range(LANE):
        for j in range(BITS // LANE):
            count = F.shiftrightunsigned(F.col(f"_s{k}"), LANE * j).bitwiseAND(F.lit(0xFFFF))
            bit = 1 << (LANE * j + k)
            bit = bit - (1 << 64) if bit >= 1 << 63 else bit
            out = out.bitwiseOR(F.when(count * 2 > F.col("_words"), F.lit(bit).cast("long"))
                                .otherwise(F.lit(0).cast("long")))
    return counted.select(*df.columns, out.alias("_fp"))


def blocks(radius: int) -> list[tuple[int, int]]:
    """(offset, width) of radius + 1 blocks that cover the 64 bits."""
    k = min(BITS, radius + 1)
    edges = [BITS * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def block_value(fp: Column, off: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, off).bitwiseAND(F.lit((1 << width) - 1))


def with_similarity(pairs: DataFrame, a: str, b: str, keys: list[str]) -> DataFrame:
    """``keys`` and ``similarity``: the weighted Jaccard of two gram arrays per pair."""
    one, none = F.lit(1), F.lit(0)
    grams_ = pairs.select(*keys, F.explode(a).alias("_x"), one.alias("_a"), none.alias("_b")
                          ).unionByName(pairs.select(*keys, F.explode(b).alias("_x"),
                                                     none.alias("_a"), one.alias("_b")))
    per = grams_.groupBy(*keys, "_x").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return per.groupBy(*keys).agg((F.sum(F.least("_a", "_b")) / F.sum(F.greatest("_a", "_b")))
                                  .alias("similarity"))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast hint only when the counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", radius: int = 20,
               least: float = 0.8) -> DataFrame:
    """One row per leaking (document, item): word position, hamming, similarity, ``_tk``."""
    it = items.select(F.col(f"`{item_id_col}`").alias("_item"),
                      words_of(F.col(f"`{item_text_col}`")).alias("_iw"))
    it = fingerprinted(it.withColumn("_n", F.size("_iw")).where("_n > 0"), "_iw")
    it = it.withColumns({"_g": F.least("_n", F.lit(NGRAM)), "_ik": F.xxhash64("_iw")})
    it = it.withColumn("_ig", reduce(
        lambda acc, s: F.when(F.col("_g") == s, grams("_iw", s)).otherwise(acc),
        range(1, NGRAM + 1), F.lit(None).cast("array<bigint>")))
    it = written(it, "items")
    sizes = [r[0] for r in it.select("_g").distinct().collect()]       # at most five
    anchors = it.select("_g", "_n", F.posexplode("_ig").alias("_j", "_h")).groupBy(
        "_g", "_n", "_j", "_h").agg(F.lit(1).alias("_one")).drop("_one")

    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"),
                       F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))).alias("_tk"),
                       words_of(text).alias("_w"))
    windows = None
    for g in sizes:
        near = _small(written(anchors.where(F.col("_g") == g), "anchors"))
        at = rows.select("_id", "_tk", "_w", F.posexplode(grams("_w", g)).alias("_p", "_h"))
        hit = at.join(near, "_h")
        # The window stays inside the document; a shorter document is one window.
        start = F.greatest(F.lit(0), F.least(F.col("_p") - F.col("_j"),
                                             F.size("_w") - F.col("_n")))
        part = hit.withColumn("_start", start).select(
            "_id", "_tk", "_n", "_g", "_start",
            F.expr("slice(_w, _start + 1, _n)").alias("_win")).distinct()
        windows = part if windows is None else windows.unionByName(part)
    if windows is None:
        return docs.sparkSession.createDataFrame(
            [], f"{id_col} {docs.schema[id_col].dataType.simpleString()}, _tk long, "
                f"{item_id_col} {items.schema[item_id_col].dataType.simpleString()}, "
                "word_start int, hamming int, similarity double")
    windows = written(fingerprinted(windows, "_win"), "windows")

    cut = blocks(radius)

    def index(df: DataFrame) -> DataFrame:
        return df.select("*", F.explode(F.array(*[
            F.struct(F.lit(k).alias("b"), block_value(F.col("_fp"), o, w).alias("v"))
            for k, (o, w) in enumerate(cut)])).alias("_x")).select("*", "_x.b", "_x.v").drop("_x")

    q, r = index(windows).alias("q"), _small(index(it.select("_item", "_ik", "_n", "_fp", "_ig"))).alias("r")
    pairs = q.join(r, F.expr("q._n = r._n AND q.b = r.b AND q.v = r.v"))
    diff = F.col("q._fp").bitwiseXOR(F.col("r._fp"))
    # A pair that agrees on several blocks is taken at the first of them.
    first = F.coalesce(*[F.when(block_value(diff, o, w) == 0, F.lit(k))
                         for k, (o, w) in enumerate(cut)])
    own = reduce(lambda acc, s: F.when(F.col("q._g") == s, grams("q._win", s)).otherwise(acc),
                 sizes, F.lit(None).cast("array<bigint>"))
    pairs = pairs.where((F.bit_count(diff) <= radius) & (first == F.col("q.b"))).select(
        "q._id", "q._tk", "q._start", "r._item", "r._ik", F.bit_count(diff).alias("hamming"),
        own.alias("_wg"), "r._ig").where("_wg IS NOT NULL")
    pairs = with_similarity(written(pairs, "pairs"), "_wg", "_ig",
                            ["_id", "_tk", "_start", "_item", "_ik", "hamming"]).where(
        F.col("similarity") >= least)
    best = pairs.groupBy("_id", "_tk", "_item").agg(F.max(F.struct(
        "similarity", (-F.col("_start")).alias("s"), "hamming")).alias("_b"))
    return best.select(F.col("_id").alias(id_col), "_tk", F.col("_item").alias(item_id_col),
                       (-F.col("_b.s")).alias("word_start"), F.col("_b.hamming").alias("hamming"),
                       F.col("_b.similarity").alias("similarity"))


def remove_leaking(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they were."""
    bad = find_leaks(docs, items, id_col, text_col, **kw).select(
        F.col(id_col).alias("_bad"), F.col("_tk").alias("_btk")).distinct().alias("x")
    d = docs.alias("d")
    key = F.xxhash64(F.coalesce(F.col(f"d.`{text_col}`").cast("string"), F.lit("")))
    return d.join(bad, (key == F.col("x._btk"))
                  & F.col(f"d.`{id_col}`").eqNullSafe(F.col("x._bad")), "left_anti")
