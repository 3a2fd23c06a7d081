"""Secret scans: fixed patterns, plus character Markov models for what they miss.

Base spans come from three patterns (an assignment of a value to a telling name, an
access-key id, a long hex run).  The method then scores every other long token with
two order-1 character models, one of random strings and one of ordinary
identifiers, and adds the tokens whose mean log-likelihood ratio per character
reaches ``threshold``.  Base spans always stay; an added span never overlaps one.

All of it is SQL expressions.  Positions come from the pieces between matches:
``split`` and ``regexp_extract_all`` walk a text the same way, so a match starts
after the pieces and matches before it.  Nothing is shuffled but the models' bigram
counts (at most 96 x 96 rows).

Training: the values of base spans are the random class, and plain words are the
ordinary class; the bigrams of both are counted over all documents.  The models are two
tables of 96 x 96 numbers and fold into one literal, whatever the corpus.

Defined results: null text = empty, no spans; repeated rows get equal results; a
corpus without any base value trains no model and adds nothing; empty table, no
rows.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, their kinds in order, and the least lengths.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
SYMBOLS = 96  # printable ASCII; anything else is symbol 0
SMOOTH, BACK_OFF = 0.5, 50.0
SPAN = "array<struct<start:int,kind:int,stop:int>>"


def spans_of(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Spans of the matches of ``pattern``; ``keep``: one boolean per match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(F.transform(gaps, lambda x: F.length(x)),
                         F.transform(hits, lambda x: F.length(x)),
                         lambda g, h: F.struct(g.alias("g"), h.alias("h")))
    # Running position over (gap, match) pairs; the last gap has no match.
    run = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + F.coalesce(x["h"], F.lit(0))).alias("at"),
            F.when(x["h"].isNull(), acc["out"]).otherwise(F.concat(
                acc["out"], F.array(F.struct(
                    (acc["at"] + x["g"]).alias("start"), F.lit(kind).alias("kind"),
                    (acc["at"] + x["g"] + x["h"]).alias("stop"))))).alias("out")),
        lambda acc: acc["out"])
    # Most texts have no match: then none of this is evaluated.
    found = F.when(F.size(hits) > 0, run).otherwise(F.expr(f"cast(array() as {SPAN})"))
    return found if keep is None else found


def _long(col: str, least: int) -> Column:
    return F.filter(F.col(col), lambda s: s["stop"] - s["start"] >= least)


def with_base_spans(rows: DataFrame) -> DataFrame:
    """Adds ``_assign``, ``_access`` and ``_hex`` (span arrays) to rows with ``_text``."""
    t = F.col("_text")
    rows = rows.withColumns({
        "_assign": spans_of(t, ASSIGN, 0), "_access": spans_of(t, ACCESS, 1),
        "_hex": spans_of(t, rf"[0-9a-f]{{{MIN_HEX},}}", 2)})
    # Group 2 is a suffix of its match (nothing follows it in the pattern).
    value = F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))
    ok = F.filter(
        F.arrays_zip(F.col("_assign").alias("s"),
                     F.when(F.size("_assign") > 0, value).alias("v")),
        lambda x: F.length(x["v"]) >= MIN_ASSIGN)
    return rows.withColumns({
        "_assign": F.when(F.size("_assign") > 0, F.transform(ok, lambda x: x["s"]))
        .otherwise(F.col("_assign")),
        "_access": _long("_access", MIN_ACCESS)})


def _symbol(c: Column) -> Column:
    code = F.ascii(c) - 31
    return F.when((code >= 1) & (code < SYMBOLS), code).otherwise(F.lit(0))


def _bigrams(strings: DataFrame) -> DataFrame:
    """(_class, string) -> counts of (class, symbol, next symbol)."""
    pairs = strings.select("_class", F.explode(F.expr(
        "transform(sequence(1, greatest(length(_s) - 1, 1)), i -> substring(_s, i, 2))"))
        .alias("_g")).where(F.length("_g") == 2)
    return pairs.groupBy("_class", _symbol(F.col("_g")).alias("_a"),
                         _symbol(F.substring("_g", 2, 1)).alias("_b")).count()


def train(rows: DataFrame) -> list[float] | None:
    """Log-likelihood ratio per bigram (row-major), or None without labelled strings."""
    found = with_base_spans(rows).where("size(_assign) + size(_access) + size(_hex) > 0")
    secret = found.select(F.lit(1).alias("_class"), F.explode(F.concat(
        F.filter(F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(2)),
                 lambda v: F.length(v) >= MIN_ASSIGN),
        F.transform(F.concat("_access", "_hex"), lambda s: F.substring(
            F.col("_text"), s["start"] + 1, s["stop"] - s["start"])))).alias("_s"))
    plain = rows.select(F.lit(0).alias("_class"), F.explode(
        F.regexp_extract_all("_text", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9_]{3,18}"
                                            r"(?![A-Za-z0-9+/_=-])"), F.lit(0))).alias("_s"))
    counts = [[0] * (SYMBOLS * SYMBOLS) for _ in range(2)]
    for r in _bigrams(secret.unionByName(plain)).collect():  # at most 2 x 96 x 96 rows
        counts[r["_class"]][r["_a"] * SYMBOLS + r["_b"]] = r["count"]
    if not sum(counts[1]) or not sum(counts[0]):
        return None
    chance = [_transitions(c) for c in counts]
    return [math.log(p1) - math.log(p0) for p0, p1 in zip(*chance)]


def _transitions(counts: list[int]) -> list[float]:
    """P(next | symbol), backed off to how common ``next`` is in the class."""
    total = sum(counts)
    alone = [(sum(counts[b::SYMBOLS]) + SMOOTH) / (total + SMOOTH * SYMBOLS)
             for b in range(SYMBOLS)]
    out = []
    for a in range(SYMBOLS):
        row = counts[a * SYMBOLS:(a + 1) * SYMBOLS]
        n = sum(row) + BACK_OFF
        out += [(c + BACK_OFF * p) / n for c, p in zip(row, alone)]
    return out


def llr_per_char(token: Column, table: list[float]) -> Column:
    lit = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0),
        lambda acc, i: acc + F.element_at(lit, _symbol(F.substring(token, i, F.lit(1))) * SYMBOLS
                                          + _symbol(F.substring(token, i + 1, F.lit(1))) + 1))
    return total / (F.length(token) - 1)


SPANS = ("_assign", "_access", "_hex", "_markov")


def scan_rows(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``_row`` (the whole input row) and the span arrays ``SPANS``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    table = train(rows.select("_text"))
    rows = with_base_spans(rows)
    if table is None:
        return rows.withColumn("_markov", F.expr(f"cast(array() as {SPAN})")).drop("_text")
    rows = rows.withColumn("_markov", spans_of(F.col("_text"), TOKEN, 3))
    base = F.concat("_assign", "_access", "_hex")
    free = F.filter(F.col("_markov"), lambda m: ~F.exists(
        base, lambda s: (s["start"] < m["stop"]) & (m["start"] < s["stop"])))
    token = lambda s: F.substring(F.col("_text"), s["start"] + 1, s["stop"] - s["start"])
    likely = F.filter(free, lambda s: llr_per_char(token(s), table) >= threshold)
    rows = rows.withColumn("_markov", F.when(F.size("_markov") > 0, likely)
                           .otherwise(F.col("_markov")))
    return rows.drop("_text")


def scan(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` plus ``_assign``, ``_access``, ``_hex``, ``_markov`` span arrays (input columns
    of these names are replaced)."""
    return scan_rows(docs, text_col, threshold).select(
        *[F.col(f"_row.`{c}`") for c in docs.columns if c not in SPANS], *SPANS)


def redact_rows(docs: DataFrame, mark: str, text_col: str = "text", size_col: str | None = None,
                threshold: float = 0.5) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``, and ``size_col``, if given,
    set to the new length; all other columns as they were, whatever their names."""
    found = scan_rows(docs, text_col, threshold)
    spans = F.concat(*SPANS)
    new = F.when(F.size(spans) > 0, redact(F.col(f"_row.`{text_col}`"), spans, mark))
    found = found.select("_row", new.alias("_new"))

    def column(c: str):
        old = F.col(f"_row.`{c}`")
        if c == text_col:
            old = F.coalesce("_new", old)
        elif c == size_col:
            old = F.coalesce(F.length("_new").cast(docs.schema[c].dataType), old)
        return old.alias(c)

    return found.select(*[column(c) for c in docs.columns])


def joined_spans(spans: Column) -> Column:
    """``kind:start:stop`` by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
        s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every span (overlaps merged) replaced by ``mark``."""
    acc0 = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["stop"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
            F.lit(mark))).alias("out"))
    done = F.aggregate(F.array_sort(spans), acc0, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
