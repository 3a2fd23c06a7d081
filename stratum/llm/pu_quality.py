"""Document quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are the rows labelled 1; every document's text is unlabelled web text.
Labels 0 are not used.

* Features of a text, all dense: shares of neighbouring character classes, word lengths,
  words repeated at once or at all, lines repeated, symbols at word ends.  They are
  written once, narrow; every later pass reads that table only.
* Class prior: a logistic model tells half of the positives from the unlabelled rows; the
  other half then gives, at each threshold, the ratio of the unlabelled to the positive
  rows above it.  The prior is the ratio at the threshold where its upper confidence
  bound is least (below it negatives mix in, far above it there are too few rows).
* Risk: with prior p and the sigmoid loss (bounded, so a positive far on its side adds no
  noise), p R+(positives) + max(0, R-(unlabelled) - p R-(positives)), minimised from that
  model by damped Newton-like steps.  Where the clipped part would turn negative, steps
  follow the positive part alone, and end if that does not help.

Scale: one pass over the texts, then passes over the feature table, each sending one sum
per task: means, gradients and d x d curvatures over *all* unlabelled rows.  The driver
holds d x d numbers and the features of at most about ``max_train`` positives, the only
sample.  Nothing is grouped by value, so copies and hot sources are harmless.

Defined results: null and empty texts have the features of no words and are scored like
any other; labels other than 1 and labels of unknown documents are ignored; a null id
is never held out and never a positive; without positives every score is 0; repeated
rows get equal scores; an empty table gives no rows; extra columns do not meet the
working ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import textwin
from stratum.llm.common import written

RIDGE = 1e-3         # weight of the squared coefficients in both risks
STEPS = 15           # steps on the PU risk at most
ENOUGH = 1e-4        # fall of the risk below which steps end
SHARPEN = 2.0        # the sigmoid loss starts from a steeper logistic model
BOUND = 8.0          # standardised features are kept within this many deviations
CONFIDENCE = 0.1     # of the bound that chooses the prior's threshold
BINS = 2000          # thresholds tried, by score

# Classes of bytes: lower case, upper case, beyond ASCII, digit, space, line break,
# comma and full stop and the like, and all other signs.
CLASSES = 8
CLASS = np.full(256, 7, np.int64)
CLASS[97:123], CLASS[65:91], CLASS[128:], CLASS[48:58] = 0, 1, 2, 3
CLASS[[32, 9]], CLASS[[10, 11, 12, 13]] = 4, 5
CLASS[[ord(c) for c in ".,;:'\"-?()"]] = 6
N_FEATURES = CLASSES * CLASSES + 12


def text_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of ``N_FEATURES`` per text of a chunk."""
    n = len(offs) - 1
    size = np.diff(offs)
    text = np.repeat(np.arange(n), size)
    kind = CLASS[data]
    pair = kind[:-1] * CLASSES + kind[1:]
    inner = text[1:] == text[:-1] if len(text) else np.empty(0, bool)
    cell = text[:-1][inner] * (CLASSES * CLASSES) + pair[inner]
    grams = np.bincount(cell, minlength=n * CLASSES * CLASSES).reshape(n, -1).astype(float)
    # Runs of blanks and line breaks alone say little: shares are of all pairs of the text.
    shares = np.sqrt(grams / np.maximum(1, size - 1)[:, None])

    w = textwin.words_of(data, offs)
    words = np.diff(w.first)
    owner = w.text_of()
    length = (w.ends - w.starts).astype(float)
    many = np.maximum(1, words)
    per = lambda x: np.bincount(owner, x, n)[:n] / many
    again = lambda k: np.bincount(
        owner[k:][(w.hashes[k:] == w.hashes[:-k]) & (owner[k:] == owner[:-k])],
        minlength=n)[:n] / many
    last = kind[w.ends - 1] if len(w.ends) else kind[:0]
    first = kind[w.starts] if len(w.starts) else kind[:0]
    distinct, top = _distinct(owner, w.hashes, n)
    lines, repeated = _lines(data, offs, w.total)
    mean = per(length)
    extra = [
        np.log1p(words), mean, np.sqrt(np.maximum(0, per(length * length) - mean * mean)),
        np.sqrt(again(1)), np.sqrt(again(2)), np.sqrt(again(3)),
        distinct / many, np.sqrt(top / many), np.sqrt(per(last == 7)),
        np.sqrt(per((first == 7) | (first == 6))), np.log1p(lines / many), np.sqrt(repeated),
    ]
    return np.concatenate([shares, np.stack(extra, axis=1)], axis=1)


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words, and how often the most frequent one occurs, per text."""
    distinct, top = np.zeros(n), np.zeros(n)
    if len(owner):
        order = np.lexsort((hashes, owner))
        o, h = owner[order], hashes[order]
        head = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (h[1:] != h[:-1])))
        distinct = np.bincount(o[head], minlength=n).astype(float)
        np.maximum.at(top, o[head], np.diff(np.append(head, len(o))).astype(float))
    return distinct, top


def _lines(data: np.ndarray, offs: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines that are not empty, and the share of those that repeat another, per text."""
    n = len(offs) - 1
    edge = np.unique(np.concatenate([offs, np.flatnonzero(data == 10) + 1]))
    a, b = edge[:-1], edge[1:]
    b = b - (data[b - 1] == 10) if len(a) else b
    a, b = a[b > a], b[b > a]
    if not len(a):
        return np.zeros(n), np.zeros(n)
    h = (total[b] - total[a]) * textwin.powers(textwin.INVERSE, len(total))[a]
    h = textwin.mix(h + (b - a).astype(textwin.U))
    owner = np.searchsorted(offs, a, "right") - 1
    lines = np.bincount(owner, minlength=n).astype(float)
    distinct, _ = _distinct(owner, h, n)
    return lines, (lines - distinct) / np.maximum(1, lines)


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _x per row of ``docs``, written."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"),
                       F.col(f"`{text_col}`").cast("string").alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            parts = [text_features(part, offs) for _, _, part, offs in
                     textwin.chunks(*textwin.buffers(b.column("_text")))]
            x = np.concatenate(parts).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("_id"), _lists(x)], ["_id", "_x"])

    return written(rows.mapInArrow(run, f"_id {id_type}, _x array<float>"), "quality-features")


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()),
                                    pa.array(x.ravel()))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("_x").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float).reshape(batch.num_rows, N_FEATURES)


def summed(table: DataFrame, numbers, size: int) -> np.ndarray:
    """The sum over all rows of ``numbers(x)`` (``size`` numbers per batch)."""
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += numbers(matrix(b))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["_k", "_s"])

    rows = table.select("_x").mapInArrow(run, "_k long, _s double").groupBy("_k").agg(
        F.sum("_s").alias("_s")).toArrow()
    out = np.zeros(size)
    out[rows["_k"].to_numpy()] = rows["_s"].to_numpy()
    return out


@dataclass
class Scale:
    """Standardisation over all documents; a constant is appended."""
    mean: np.ndarray
    width: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.width, -BOUND, BOUND)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def fit_scale(table: DataFrame) -> Scale:
    d = N_FEATURES
    s = summed(table, lambda x: np.concatenate([x.sum(0), (x * x).sum(0), [len(x)]]), 2 * d + 1)
    n = max(1.0, s[-1])
    mean = s[:d] / n
    return Scale(mean, np.sqrt(np.maximum(s[d:2 * d] / n - mean * mean, 0.0)) + 1e-3)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def curvature_sums(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return ((x * weight[:, None]).T @ x)[np.triu_indices(x.shape[1])]


def square(upper: np.ndarray, d: int) -> np.ndarray:
    out = np.zeros((d, d))
    out[np.triu_indices(d)] = upper
    return out + np.triu(out, 1).T


@dataclass
class Risk:
    value: float
    gradient: np.ndarray
    curve: np.ndarray       # positive definite; exact for the logistic loss


def logistic_risk(table: DataFrame, scale: Scale, positives: np.ndarray, w: np.ndarray) -> Risk:
    """Positives against all documents, half the weight each, logistic loss."""
    d = len(w)

    def numbers(x: np.ndarray) -> np.ndarray:
        x = scale(x)
        z = x @ w
        s = sigmoid(z)
        return np.concatenate([[len(x), softplus(z).sum()], s @ x,
                               curvature_sums(x, s * (1 - s))])

    out = summed(table, numbers, 2 + d + d * (d + 1) // 2)
    n = max(1.0, out[0])
    z = positives @ w
    s = sigmoid(z)
    ridge = RIDGE * np.append(w[:-1], 0.0)
    h = square(out[2 + d:] / n, d) + square(curvature_sums(positives, s * (1 - s)), d) / len(z)
    return Risk(0.5 * (softplus(-z).mean() + out[1] / n) + 0.5 * float(ridge @ w),
                0.5 * (out[2:2 + d] / n - (1 - s) @ positives / len(z)) + ridge,
                0.5 * h + RIDGE * np.eye(d))


def pu_risk(table: DataFrame, scale: Scale, positives: np.ndarray, prior: float,
            w: np.ndarray) -> Risk:
    """The non-negative PU risk of the sigmoid loss at ``w``."""
    d = len(w)

    def numbers(x: np.ndarray) -> np.ndarray:
        x = scale(x)
        s = sigmoid(x @ w)
        flat = s * (1 - s)
        return np.concatenate([[len(x), s.sum()], flat @ x, curvature_sums(x, flat)])

    out = summed(table, numbers, 2 + d + d * (d + 1) // 2)
    n = max(1.0, out[0])
    s = sigmoid(positives @ w)
    flat = s * (1 - s)
    g_pos = flat @ positives / len(s)                   # of the mean score of the positives
    h_pos = square(curvature_sums(positives, flat), d) / len(s)
    ridge = RIDGE * np.append(w[:-1], 0.0)
    eye = RIDGE * np.eye(d)
    negative = out[1] / n - prior * s.mean()            # risk of the negatives, unbiased
    value = prior * (1 - s.mean()) + max(0.0, negative) + 0.5 * float(ridge @ w)
    if negative < 0:                                    # clipped: only the positive part counts
        return Risk(value, ridge - prior * g_pos, prior * h_pos + eye)
    return Risk(value, out[2:2 + d] / n - 2 * prior * g_pos + ridge,
                square(out[2 + d:] / n, d) + 2 * prior * h_pos + eye)


def descend(risk, w: np.ndarray, steps: int) -> np.ndarray:
    """Newton-like steps on ``risk(w)``, shortened until it falls."""
    at = risk(w)
    for _ in range(steps):
        step = np.linalg.solve(at.curve, at.gradient)
        for share in (1.0, 0.25, 0.05):
            new = risk(w - share * step)
            if new.value < at.value:
                break
        else:
            break
        w, gain, at = w - share * step, at.value - new.value, new
        if gain < ENOUGH:
            break
    return w


def class_prior(table: DataFrame, scale: Scale, positives: np.ndarray,
                steps: int = 12) -> tuple[float, np.ndarray]:
    """(prior, start): the share of positives among all documents, by the best threshold of a
    model that tells the even positives from all documents, judged on the odd ones; and
    that model, moved so that the threshold is its 0."""
    taught = positives[::2]
    model = descend(lambda w: logistic_risk(table, scale, taught, w),
                    np.zeros(positives.shape[1]), steps)
    judged = positives[1::2] if len(positives) > 1 else positives
    edges = np.linspace(0.0, 1.0, BINS + 1)
    hist = lambda z: np.histogram(sigmoid(z), edges)[0].astype(float)
    u = summed(table, lambda x: hist(scale(x) @ model), BINS)
    p = hist(judged @ model)
    above = lambda h: np.cumsum(h[::-1])[::-1] / max(1.0, h.sum())
    qu, qp = above(u), above(p)
    slack = np.sqrt(np.log(4 / CONFIDENCE) / 2) * (
        1 / np.sqrt(max(1.0, u.sum())) + 1 / np.sqrt(max(1.0, p.sum())))
    bound = np.where(qp > 0, (qu + slack) / np.maximum(qp, 1e-12), np.inf)
    best = int(np.argmin(bound))
    cut = np.clip(edges[best], 1e-6, 1 - 1e-6)
    start = model.copy()
    start[-1] -= np.log(cut / (1 - cut))
    return float(min(1.0, max(1e-3, qu[best] / qp[best]))), start


@dataclass
class Model:
    scale: Scale | None
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.scale is None:
            return np.zeros(len(x))
        return sigmoid(self.scale(x) @ self.weights)


def positive_rows(table: DataFrame, labels: DataFrame, id_col: str, label_col: str,
                  max_train: int, seed: int) -> np.ndarray:
    """Features of the positives outside the held-out fifth; ``max_train`` in expectation."""
    known = labels.where((F.col(f"`{label_col}`") == 1) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("_known"))
    known = known.where(F.crc32(F.col("_known").cast("string").cast("binary")) % 5 != 0).distinct()
    n = known.count()
    if n > max_train:
        share = -(-max_train * (1 << 62) // n)
        draw = F.xxhash64(F.lit(seed), F.col("_known").cast("string")).bitwiseAND(
            F.lit((1 << 62) - 1))
        known = known.where(draw < F.lit(share))
    # At most about ``max_train`` ids; equal ids of documents are drawn once each.
    rows = (table.join(F.broadcast(known), F.col("_id") == F.col("_known"))
            .groupBy("_id").agg(F.min("_x").alias("_x")).orderBy(F.xxhash64("_id"), "_id").toArrow())
    x = [matrix(b) for b in rows.to_batches() if b.num_rows]
    return np.concatenate(x) if x else np.empty((0, N_FEATURES))


def fit(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        max_train: int = 20_000, seed: int = 13) -> Model:
    raw = positive_rows(table, labels, id_col, label_col, max_train, seed)
    if not len(raw):
        return Model(None, np.zeros(N_FEATURES + 1), 0.0)
    scale = fit_scale(table)
    positives = scale(raw)
    prior, start = class_prior(table, scale, positives)
    weights = descend(lambda w: pu_risk(table, scale, positives, prior, w), start * SHARPEN, STEPS)
    return Model(scale, weights, prior)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality",
                    max_train: int = 20_000, seed: int = 13, accept_from: float = 0.3) -> DataFrame:
    """id, held_out, score, predicted per row of ``docs``."""
    table = feature_table(docs, id_col, text_col)
    model = fit(table, labels, id_col, label_col, max_train, seed)
    shared = docs.sparkSession.sparkContext.broadcast(model)       # some hundred numbers
    id_type = table.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            score = shared.value.score(matrix(b))
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(score)], ["_id", "score"])

    held = F.crc32(F.col("_id").cast("string").cast("binary")) % 5 == 0
    return table.mapInArrow(run, f"_id {id_type}, score double").select(
        F.col("_id").alias(id_col), F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= accept_from).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", max_train: int = 20_000, seed: int = 13,
              accept_from: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``accept_from`` or more, all columns as they were."""
    model = fit(feature_table(docs, id_col, text_col), labels, id_col, label_col, max_train, seed)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            keep = [shared.value.score(text_features(part, offs)) >= accept_from for _, _, part, offs
                    in textwin.chunks(*textwin.buffers(b.column(text_col)))]
            yield b.filter(pa.array(np.concatenate(keep) if keep else [], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
