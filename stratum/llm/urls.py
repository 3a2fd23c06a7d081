"""URL filters: rules first, gradient-boosted trees on lexical features for the rest.

Labelled URLs train a boosted-tree classifier (``GBTClassifier``) on what a URL
looks like: length, depth, digit ratio, character entropy, parameter counts and
statistics of its suffix (how common the last host label is, and how long).  A URL
that a rule fits takes the rule's verdict; the longest rule wins.

Everything is DataFrame expressions and MLlib's JVM code: features, scoring and the
rules run in one scan of the ``url`` column without a shuffle of the pages; the labelled URLs
are shuffled once, pre-aggregated per task, to count their copies.

Training reads at most ``max_train`` labelled URLs in expectation (a hash-threshold
sample, the documented bound), each once and weighted by its rows; suffix counts cover all rows.  The suffix table is
joined by Spark's size-based choice, pre-aggregated per task, so a suffix with a
third of all rows is one row per task.

Defined results: null url or no ``://`` gives empty host and path, no rule, and the
model's verdict on the empty features; repeated rows get equal verdicts; with no
labelled URLs, or labels of one class only, the model allows, or says that class; an
empty table gives no rows; extra columns stay out of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import lower_ascii, written

FEATURES = ["length", "host_length", "path_length", "depth", "host_depth", "digit_ratio",
            "entropy", "n_params", "n_hyphens", "has_fragment", "is_https", "suffix_length",
            "suffix_share", "path_digit_ratio", "query_length"]
DRAW = 62  # bits of the hash that draws the training URLs
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-./_?=&%:#"


@dataclass(frozen=True)
class Rule:
    """``text`` is host then path, as in ``example.net/en/``."""
    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(
        F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda x: (len(x.text), x.text)):  # longest is tested first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.text)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _count(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch)))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _digits(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, "0123456789", ""))


def with_features(urls: DataFrame) -> DataFrame:
    """``_url, _host, _path`` -> plus the lexical features but ``suffix_share``."""
    url = F.coalesce(F.col("_url"), F.lit(""))
    n = F.length(url)
    low = F.lower(url)
    entropy = F.lit(0.0)
    for ch in ALPHABET:
        p = _ratio(_count(low, ch), n)
        entropy = entropy - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    suffix = F.substring_index(F.col("_host"), ".", -1)
    d = {
        "length": n, "host_length": F.length("_host"), "path_length": F.length("_path"),
        "depth": _count(F.col("_path"), "/"), "host_depth": _count(F.col("_host"), "."),
        "digit_ratio": _ratio(_digits(url), n), "entropy": entropy,
        "n_params": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(F.lit(0)),
        "n_hyphens": _count(F.col("_host"), "-"),
        "has_fragment": F.contains(url, F.lit("#")).cast("int"),
        "is_https": url.startswith("https://").cast("int"),
        "suffix_length": F.length(suffix),
        "path_digit_ratio": _ratio(_digits(F.col("_path")), F.length("_path")),
        "query_length": F.length(query),
    }
    return urls.withColumns({k: v.cast("double") for k, v in d.items()} | {"_suffix": suffix})


def fit(labelled: DataFrame, complete: Callable[[DataFrame], DataFrame], max_train: int,
        trees: int, depth: int, seed: int):
    """The trained model; or the verdict to give when there is nothing to learn.

    ``labelled``: a row per URL and verdict, ``_w`` the rows that have both; about
    ``max_train`` of these are drawn, and weigh as much as the rows they stand for.
    ``complete`` adds the features.
    """
    per = labelled.groupBy("_verdict").agg(F.sum("_w"), F.count(F.lit(1))).collect()
    counts = {r[0]: r[1] for r in per}
    if len(counts) < 2:
        return next(iter(counts), "allow")
    limit = min(1 << DRAW, -(-(max_train << DRAW) // sum(r[2] for r in per)))
    draw = F.xxhash64(F.lit(seed), F.coalesce("_url", F.lit(""))).bitwiseAND(
        F.lit((1 << DRAW) - 1))
    train = complete(labelled.where(draw < F.lit(limit)))
    train = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(
        train.withColumns({"_y": (F.col("_verdict") == "block").cast("double"),
                           "_w": F.col("_w").cast("double")})).select("_x", "_y", "_w")
    # Bounded by max_train, so a few partitions do; training runs many short jobs.
    train = written(train, "url-train").coalesce(4)
    if train.select("_y").distinct().count() < 2:
        return max(counts, key=lambda k: (counts[k], k))
    return GBTClassifier(featuresCol="_x", labelCol="_y", predictionCol="_p", weightCol="_w",
                         maxIter=trees, maxDepth=depth, seed=seed).fit(train)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id",
                url_col: str = "url", labels: Column | None = None, max_train: int = 20_000,
                trees: int = 20, depth: int = 4, seed: int = 7) -> DataFrame:
    """id, host, path, rule, verdict and ``block_score`` (the method's probability).

    ``labels``: 'block' / 'allow' / null per row of ``pages``; by default the rules'
    own verdicts label the URLs that they fit.
    """
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), url.alias("_url"),
                        (labels if labels is not None else F.lit(None).cast("string"))
                        .alias("_label"))
    rows = rows.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    rule, verdict = rule_for(rules, F.col("_host"), F.col("_path"))
    rows = rows.withColumns({"_rule": rule, "_said": verdict})
    rows = rows.withColumn("_verdict", F.coalesce("_label", "_said"))
    feats = with_features(rows)
    # Statistics over all rows; one row per suffix.
    per = feats.groupBy("_suffix").agg(F.count(F.lit(1)).alias("_n"))
    total = per.agg(F.sum("_n")).first()[0] or 1

    def with_share(df: DataFrame) -> DataFrame:
        return df.join(per, "_suffix", "left").withColumn(
            "suffix_share", F.coalesce(F.col("_n") / F.lit(float(total)), F.lit(0.0)))

    feats = with_share(feats)
    # All copies of a URL are one row before anything is drawn.
    labelled = written(rows.where("_verdict IS NOT NULL").groupBy(
        "_url", "_host", "_path", "_verdict").agg(F.count(F.lit(1)).alias("_w")), "url-labels")
    model = fit(labelled, lambda df: with_share(with_features(df)), max_train, trees, depth, seed)
    if isinstance(model, str):
        scored = feats.withColumn("_score", F.lit(1.0 if model == "block" else 0.0))
    else:
        scored = model.transform(
            VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(feats))
        from pyspark.ml.functions import vector_to_array
        scored = scored.withColumn("_score", vector_to_array("probability")[1])
    by_model = F.when(F.col("_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("_id").alias(id_col), F.col("_host").alias("host"),
                         F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                         F.coalesce(F.col("_said"), by_model).alias("verdict"),
                         F.col("_score").alias("block_score"))
