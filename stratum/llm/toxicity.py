"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

A bounded sample of labelled rows (``max_train``, documented) gives the vocabulary,
the inverse document frequencies and the examples.  Terms are words and their
four-byte stems; those in at least ``LEAST_DOCS`` examples, whatever the size of the
sample, whose rates differ between the two labels by at least ``LEAST_Z`` standard errors
are the vocabulary, all of them; other words weigh nothing.  Every text, whole, becomes a
unit TF-IDF vector, and its ``k`` nearest examples come from block-max inverted lists:
per term and block of examples the index holds the largest weight, so a block's best
possible cosine is known before its lists are read, blocks are visited from the most
promising, and the search stops when no unread block can reach the k-th best.  The result equals a full scan.

Votes are weighted by closeness (1 / (margin + 1 - cosine)); an isotonic fit of the
votes that the examples get from each other (each left out in turn) turns a vote into
a calibrated score.  The nearest examples are returned as evidence.

Scale: texts are scored where they are read, no text is shuffled.  The labels meet the
documents through a broadcast bounded by ``max_train``, and the index (at most
``max_train`` vectors) is broadcast.

Defined results: null or empty texts, and texts without a vocabulary word, get the
rate of such examples; labels other than 0 and 1 and labels of unknown documents are
ignored; with one class only, or no label, every score is the smoothed rate of label
1 (0 without labels); repeated rows get equal scores; an empty table gives no rows; a
null id is never held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import textwin
from stratum.llm.common import written

STEM = 4          # bytes of a word's stem
MARGIN = 0.02     # keeps an equal example from outvoting all others
BLOCK = 64        # examples per block
FREQUENT = 16     # a term in more than 1 / FREQUENT of the examples is frequent
LEAST_Z = 3.0     # difference of the two labels' rates, in standard errors
LEAST_DOCS = 3    # examples with a term; below, the standard error says nothing
EVIDENCE = 3


def term_counts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct term hashes, counts) per text."""
    data, offs = textwin.buffers(batch.column(column))
    for _, _, part, po in textwin.chunks(data, offs):
        w = textwin.words_of(part, po, lower=True, blank=textwin.PUNCT)
        stems = w.prefixes(STEM)
        for a, b in zip(w.first[:-1], w.first[1:]):
            yield np.unique(np.concatenate([w.hashes[a:b], stems[a:b]]), return_counts=True)


@dataclass
class Vocabulary:
    terms: np.ndarray   # sorted hashes
    idf: np.ndarray

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, weights) of a text; unit length, or empty."""
        if not len(self.terms) or not len(terms):
            return np.empty(0, np.int64), np.empty(0)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        ok = self.terms[at] == terms
        at = at[ok]
        v = (1.0 + np.log(counts[ok])) * self.idf[at]
        norm = np.sqrt((v * v).sum())
        return (at, v / norm) if norm > 0 else (at[:0], v[:0])


class BlockMaxIndex:
    """Inverted lists in (term, block) cells, each with its largest weight."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        # Examples with the same heaviest term stand together: blocks get tight bounds.
        lead = [int(t[np.argmax(v)]) if len(t) else -1 for t, v in vectors]
        self.order = np.argsort(lead, kind="stable")        # slot -> example
        self.slot_of = np.argsort(self.order)               # example -> slot
        self.n = len(vectors)
        self.n_blocks = -(-self.n // BLOCK) if self.n else 0
        slot = np.concatenate([np.full(len(vectors[e][0]), s) for s, e in
                               enumerate(self.order)] or [np.empty(0, int)]).astype(np.int64)
        term = np.concatenate([vectors[e][0] for e in self.order] or [np.empty(0, int)]).astype(
            np.int64)
        weight = np.concatenate([vectors[e][1] for e in self.order] or [np.empty(0)])
        by = np.lexsort((slot, term))
        self.slot, term, self.weight = slot[by], term[by], weight[by]
        cell = term * max(1, self.n_blocks) + self.slot // BLOCK
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else cell
        self.cell_start = np.append(first, len(cell)).astype(np.int64)
        self.cell_block = (cell[first] % max(1, self.n_blocks)).astype(np.int64)
        self.cell_max = np.maximum.reduceat(self.weight, first) if len(cell) else self.weight
        self.term_cell = np.searchsorted(cell[first] // max(1, self.n_blocks),
                                         np.arange(n_terms + 1))
        # The lists of frequent terms are kept as rows over all examples: read faster.
        df = np.bincount(term, minlength=n_terms)
        frequent = np.flatnonzero(df * FREQUENT > max(1, self.n))
        self.row_of = np.full(n_terms, -1, np.int64)
        self.row_of[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), self.n_blocks * BLOCK))
        mine = self.row_of[term] >= 0
        self.rows[self.row_of[term[mine]], self.slot[mine]] = self.weight[mine]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int,
                skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the best ``k`` with a cosine above 0, best first."""
        lo, hi = self.term_cell[terms], self.term_cell[terms + 1]
        cells = _ranges(lo, hi)
        if not len(cells):
            return np.empty(0, np.int64), np.empty(0)
        w = np.repeat(weights, hi - lo)
        row = self.row_of[terms]
        listed = np.repeat(row < 0, hi - lo)
        rows, row_w = row[row >= 0], weights[row >= 0]
        blocks = self.cell_block[cells]
        bound = np.bincount(blocks, w * self.cell_max[cells], self.n_blocks)
        visit = np.argsort(-bound, kind="stable")
        visit = visit[bound[visit] > 0]
        rank = np.full(self.n_blocks, len(visit), np.int64)
        rank[visit] = np.arange(len(visit))
        # Cells of lists in the order in which their blocks are visited.
        cells, w, place = cells[listed], w[listed], rank[blocks[listed]]
        by = np.argsort(place, kind="stable")
        cells, w, place = cells[by], w[by], place[by]
        found_s, found_c, kth = np.empty(0, np.int64), np.empty(0), 0.0
        at, step = 0, max(16, -(-2 * k // BLOCK))
        while at < len(visit) and (len(found_s) < k or bound[visit[at]] >= kth - 1e-12):
            a, b = np.searchsorted(place, [at, at + step])
            start, stop = self.cell_start[cells[a:b]], self.cell_start[cells[a:b] + 1]
            post = _ranges(start, stop)
            score = np.bincount(self.slot[post], np.repeat(w[a:b], stop - start)
                                * self.weight[post], self.n).astype(float, copy=False)
            if len(rows):
                self._add_rows(score, rows, row_w, visit[at:at + step])
            if skip >= 0:
                score[self.slot_of[skip]] = 0.0
            # Only what can stay among the best k (ties included) is ordered.
            got = np.flatnonzero(score >= kth if len(found_s) == k else score)
            if len(got) > 4 * k:
                got = got[score[got] >= np.partition(score[got], len(got) - k)[len(got) - k]]
            found_s = np.concatenate([found_s, got])
            found_c = np.concatenate([found_c, score[got]])
            best = np.lexsort((self.order[found_s], -found_c))[:k]
            found_s, found_c = found_s[best], found_c[best]
            kth = found_c[-1] if len(found_c) else 0.0
            at += step
            # Then all blocks that can still hold one of the best, at once.
            step = (int(np.searchsorted(-bound[visit], -(kth - 1e-12), "right")) - at
                    if len(found_s) == k else 2 * step)
            step = max(step, 1)
        return self.order[found_s], np.minimum(found_c, 1.0)


    def _add_rows(self, score: np.ndarray, rows: np.ndarray, weights: np.ndarray,
                  blocks: np.ndarray) -> None:
        """Add what the frequent terms give to the examples of some blocks."""
        if 2 * len(blocks) > self.n_blocks:
            full = np.zeros(len(self.rows))
            full[rows] = weights
            part = full @ self.rows
            seen = np.zeros(self.n_blocks, bool)
            seen[blocks] = True
            score += np.where(np.repeat(seen, BLOCK), part, 0.0)[:self.n]
            return
        slots = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        slots = slots[slots < self.n]
        score[slots] += weights @ self.rows[np.ix_(rows, slots)]


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo[0]..hi[0]-1, lo[1]..hi[1]-1, ..."""
    n = hi - lo
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(lo - (ends - n), n)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators; (centres, smoothed means) of the pooled runs."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []     # [sum of y, count, sum of x]
    for a, b in zip(x[order], y[order]):
        pools.append([b, 1, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    base = y.mean()
    return (np.array([p[2] / p[1] for p in pools]),
            np.array([(p[0] + base) / (p[1] + 1) for p in pools]))


@dataclass
class Model:
    vocabulary: Vocabulary
    index: BlockMaxIndex | None
    labels: np.ndarray
    ids: np.ndarray
    k: int
    knots: tuple[np.ndarray, np.ndarray]
    no_term: float     # score of texts without a vocabulary term
    rate: float

    def vote(self, at: np.ndarray, cos: np.ndarray) -> float:
        w = 1.0 / (MARGIN + 1.0 - cos)
        return float((w * self.labels[at]).sum() / w.sum())

    def score(self, terms: np.ndarray, counts: np.ndarray):
        """(score, evidence ids, evidence cosines)."""
        if self.index is None:
            return self.rate, (), ()
        t, v = self.vocabulary.vector(terms, counts)
        at, cos = self.index.nearest(t, v, self.k)
        if not len(at):
            return self.no_term, (), ()
        s = float(np.interp(self.vote(at, cos), *self.knots))
        top = at[:EVIDENCE]
        return min(1.0, max(0.0, s)), self.ids[top], cos[:EVIDENCE]


def fit(examples: DataFrame, k: int) -> Model:
    """``examples`` (_id, _text, _y): the bounded training sample, a written table."""
    def count(batches):
        for b in batches:
            y = b.column("_y").to_numpy(zero_copy_only=False)
            per = list(term_counts(b, "_text"))
            if not per:
                continue
            h = np.concatenate([p[0] for p in per])
            label = np.repeat(y, [len(p[0]) for p in per])
            u, inv = np.unique(h, return_inverse=True)
            n1 = np.bincount(inv, label, len(u)).astype(np.int64)
            n = np.bincount(inv, minlength=len(u)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n1),
                                              pa.array(n)], ["_h", "_n1", "_n"])

    n1, n = (int(x or 0) for x in examples.agg(F.sum("_y"), F.count(F.lit(1))).first())
    rate = (n1 + 0.5) / (n + 1) if n else 0.0
    none = Vocabulary(np.empty(0, textwin.U), np.empty(0))
    if n1 == 0 or n1 == n:
        return Model(none, None, np.empty(0), np.empty(0), k, (np.zeros(1), np.zeros(1)),
                     rate, rate)
    n0 = n - n1
    share = F.col("_n") / F.lit(float(n))
    gap = (F.col("_n1") / F.lit(float(n1)) - (F.col("_n") - F.col("_n1")) / F.lit(float(n0)))
    z = F.abs(gap) / F.sqrt(share * (1 - share) * F.lit(1.0 / n1 + 1.0 / n0) + F.lit(1e-12))
    top = (examples.mapInArrow(count, "_h long, _n1 long, _n long").groupBy("_h")
           .agg(F.sum("_n1").alias("_n1"), F.sum("_n").alias("_n"))
           .where((F.col("_n") >= LEAST_DOCS) & (z >= LEAST_Z))
           .toArrow())                          # bounded by the terms of the sample
    h = top["_h"].to_numpy().view(textwin.U)
    order = np.argsort(h)
    vocabulary = Vocabulary(h[order], np.log((1 + n) / (1 + top["_n"].to_numpy()[order])) + 1e-9)
    shared = examples.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches):
        for b in batches:
            pairs = [shared.value.vector(*p) for p in term_counts(b, "_text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").cast(pa.string()), b.column("_y"),
                 pa.array([t.tolist() for t, _ in pairs], pa.list_(pa.int64())),
                 pa.array([v.tolist() for _, v in pairs], pa.list_(pa.float64()))],
                ["_id", "_y", "_t", "_v"])

    # At most ``max_train`` sparse vectors.
    rows = examples.orderBy("_tk", "_id").mapInArrow(
        vectors, "_id string, _y int, _t array<long>, _v array<double>").toArrow()
    vecs = [(np.array(t, np.int64), np.array(v)) for t, v in zip(rows["_t"].to_pylist(),
                                                                 rows["_v"].to_pylist())]
    labels = rows["_y"].to_numpy().astype(float)
    index = BlockMaxIndex(vecs, len(vocabulary.terms))
    model = Model(vocabulary, index, labels, np.array(rows["_id"].to_pylist(), object), k,
                  (np.zeros(1), np.zeros(1)), rate, rate)
    votes, truth, bare = [], [], []
    for i, (t, v) in enumerate(vecs):          # each example judged by the others
        at, cos = index.nearest(t, v, k, skip=i)
        if len(at):
            votes.append(model.vote(at, cos))
            truth.append(labels[i])
        else:
            bare.append(labels[i])
    if votes:
        model.knots = isotonic(np.array(votes), np.array(truth))
    model.no_term = (sum(bare) + rate) / (len(bare) + 1)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                  max_train: int, seed: int) -> DataFrame:
    """Labelled rows outside the held-out fifth; ``max_train`` of them in expectation."""
    y = F.col(f"`{label_col}`")
    known = labels.where(y.isin(0, 1) & F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("_id"), y.cast("int").alias("_y"))
    known = known.where(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0)
    n = known.count()
    if n > max_train:
        share = -(-max_train * (1 << 62) // n)          # never 0, however many labels
        # The low 20 bits of the hash lead, 42 further ones refine them.
        h = F.xxhash64(F.lit(seed), F.col("_id").cast("string"))
        draw = F.shiftleft(h.bitwiseAND(F.lit((1 << 20) - 1)), 42).bitwiseOR(
            F.shiftrightunsigned(h, 20).bitwiseAND(F.lit((1 << 42) - 1)))
        known = known.where(draw < F.lit(share))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text"))
    # Bounded by max_train rows of two numbers, so the broadcast is.
    return written(rows.join(F.broadcast(known), "_id").withColumn("_tk", F.xxhash64("_text")),
                   "toxicity-train")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", max_train: int = 8000,
                    k: int = 15, seed: int = 5) -> DataFrame:
    """id, held_out, score, predicted and evidence (ids and cosines) per row of ``docs``."""
    model = fit(training_rows(docs, labels, id_col, text_col, label_col, max_train, seed), k)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"),
                       F.col(f"`{text_col}`").cast("string").alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in batches:
            out = [m.score(*p) for p in term_counts(b, "_text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array([x[0] for x in out], pa.float64()),
                 pa.array([list(x[1]) for x in out], pa.list_(pa.string())),
                 pa.array([[float(c) for c in x[2]] for x in out], pa.list_(pa.float64()))],
                ["_id", "score", "evidence_ids", "evidence_cosines"])

    scored = rows.mapInArrow(run, f"_id {id_type}, score double, evidence_ids array<string>, "
                                  "evidence_cosines array<double>")
    held = F.crc32(F.col("_id").cast("string").cast("binary")) % 5 == 0
    return scored.select(
        F.col("_id").alias(id_col), F.coalesce(held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence_ids",
        "evidence_cosines")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", max_train: int = 8000, k: int = 15, seed: int = 5,
               reject_from: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``reject_from``, all columns as they were."""
    model = fit(training_rows(docs, labels, id_col, text_col, label_col, max_train, seed), k)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m.score(*p)[0] < reject_from
                                     for p in term_counts(b, text_col)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
