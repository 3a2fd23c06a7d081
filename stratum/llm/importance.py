"""Target-distribution importance resampling with hashed n-gram features.

A text's features are all runs of 1 to ``max_run`` consecutive words (lower-cased A-Z;
letters, digits and everything beyond ASCII make words), joined by one space; a
feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.  Counting the
buckets of the corpus and of the target texts gives every bucket a gain, the log ratio
of their smoothed rates; a document's weight is the mean gain of its features.  Gumbel
noise from a hash of the seed and the id turns the weights into a sample without
replacement: the highest ``percent`` of the scores among the documents with at least
``min_words`` words are drawn.

The CRC is linear over GF(2) but for a constant of the length, so it is the XOR of one
contribution per byte, looked up by the byte and its distance from the end of the span
(``CONTRIBUTION``), reduced over all spans of a batch at once with
``bitwise_xor.reduceat``, then XORed with the length's constant.  Spans longer than the
table are cut into blocks from their end; block values are folded in pairs, the left
one moved by the (doubling) length of the right one, so a span of n bytes takes log n
folds and the work per step is bounded.

Scale: two passes over the texts where they lie.  The first sends at most ``buckets``
counts per task, the second writes narrow rows (id, counts, score).  The cut comes from a
histogram of the integer scores, whose range is bounded by the logarithms; only rows at
or above it are sorted, by (score, id, row number), so that equal rows (a third of all
rows without an id, say) spread over the range partitions.  Ranks are the position in
the sorted table: a partition's offset plus the place in it, no window and no join.

Defined results: null and empty texts have no features, weight 0, and are never drawn
while ``min_words`` is above 0; a null id is hashed as ``null`` and comes last among
equal scores; repeated rows are rows of their own; an empty corpus gives no rows, an
empty target smoothed gains; extra columns do not meet the working ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm import textwin
from stratum.llm.common import written

POLYNOMIAL = 0xEDB88320   # CRC-32, reflected
DEPTH = 64                # bytes that the contribution table reaches back
GROUP = 1 << 21           # bytes of spans worked on at once
LEVELS = 40               # spans up to DEPTH * 2 ** LEVELS bytes


def _byte_steps() -> np.ndarray:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    return step.astype(np.uint32)


STEP = _byte_steps()


def _advance(state: np.ndarray) -> np.ndarray:
    """The CRC register after one more zero byte."""
    return (state >> np.uint32(8)) ^ STEP[state & np.uint32(255)]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Contribution by (distance from the end, byte); all-ones register by zero bytes."""
    rows, start = [STEP], [np.array([0xFFFFFFFF], np.uint32)]
    for _ in range(DEPTH - 1):
        rows.append(_advance(rows[-1]))
    for _ in range(DEPTH):
        start.append(_advance(start[-1]))
    return np.stack(rows), np.concatenate(start)


CONTRIBUTION, START = _tables()
_moves: list[np.ndarray] = []


def move(state: np.ndarray, level: int) -> np.ndarray:
    """The register after ``DEPTH * 2 ** level`` zero bytes, by its four bytes."""
    while len(_moves) <= level:
        if not _moves:
            table = (np.arange(256, dtype=np.uint32)[None, :]
                     << (8 * np.arange(4, dtype=np.uint32))[:, None])
            for _ in range(DEPTH):
                table = _advance(table)
        else:
            last = len(_moves) - 1
            table = move(move(_identity(), last), last)
        _moves.append(table)
    t = _moves[level]
    return (t[0][state & np.uint32(255)] ^ t[1][(state >> np.uint32(8)) & np.uint32(255)]
            ^ t[2][(state >> np.uint32(16)) & np.uint32(255)] ^ t[3][state >> np.uint32(24)])


def _identity() -> np.ndarray:
    return (np.arange(256, dtype=np.uint32)[None, :]
            << (8 * np.arange(4, dtype=np.uint32))[:, None])


def length_constants(n: np.ndarray) -> np.ndarray:
    """CRC-32 of ``n`` zero bytes: what a span's length adds to its contributions."""
    state = START[n % DEPTH]
    blocks, level = n // DEPTH, 0
    while level < LEVELS and (blocks >> level).any():
        on = (blocks >> level) & 1 == 1
        if on.any():
            state[on] = move(state[on], level)
        level += 1
    return state ^ np.uint32(0xFFFFFFFF)


def _block_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each block (1 to DEPTH bytes), a bounded group at a time."""
    size = ends - starts
    upto = np.cumsum(size)
    out = np.empty(len(starts), np.uint32)
    table = CONTRIBUTION.reshape(-1)
    i = 0
    while i < len(starts):
        base = upto[i] - size[i]
        j = max(i + 1, int(np.searchsorted(upto, base + GROUP, "right")))
        first = upto[i:j] - size[i:j] - base
        at = np.arange(upto[j - 1] - base) + np.repeat(starts[i:j] - first, size[i:j])
        back = np.repeat(ends[i:j] - 1, size[i:j]) - at
        out[i:j] = np.bitwise_xor.reduceat(table[(back << 8) | data[at]], first)
        i = j
    return out


def span_crc(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the non-empty byte spans ``data[starts[i]:ends[i]]``."""
    size = ends - starts
    if not len(size):
        return np.empty(0, np.uint32)
    fixed = length_constants(size)
    if size.max() <= DEPTH:
        return _block_values(data, starts, ends) ^ fixed
    blocks = -(-size // DEPTH)
    # Blocks of a span follow each other from its end to its start.
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    b_end = np.repeat(ends, blocks) - place * DEPTH
    value = _block_values(data, np.maximum(np.repeat(starts, blocks), b_end - DEPTH), b_end)
    level = 0
    while blocks.max() > 1:
        right = np.flatnonzero(place % 2 == 0)
        paired = place[right] + 1 < np.repeat(blocks, (blocks + 1) // 2)
        folded = value[right]
        folded[paired] ^= move(value[right[paired] + 1], level)
        value, blocks, level = folded, (blocks + 1) // 2, level + 1
        first = np.cumsum(blocks) - blocks
        place = np.arange(len(value)) - np.repeat(first, blocks)
    return value ^ fixed


def joined_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """The words of each text, lower-cased, one space after each: (bytes, starts, ends,
    first word of every text and the end)."""
    low = textwin.LOWER[data]
    n = len(low)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~textwin.PUNCT[low]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:n]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    size = ends - starts
    begin = np.cumsum(size + 1) - (size + 1)
    at = np.arange(int(size.sum()) + len(size)) + np.repeat(starts - begin, size + 1)
    out = low[np.minimum(at, max(0, n - 1))] if len(at) else low[:0]
    out[begin + size] = 32
    return out, begin, begin + size, np.searchsorted(starts, offs)


def bucket_runs(data: np.ndarray, offs: np.ndarray, max_run: int,
                buckets: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """([(bucket, text)] per run length, words per text) of a chunk of texts."""
    joined, starts, ends, first = joined_words(data, offs)
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(n_words)), n_words)
    out = []
    for run in range(max_run):
        last = np.arange(run, len(starts))
        if run:
            last = last[text[run:] == text[:-run]]
        head = last - run
        crc = span_crc(joined, starts[head], ends[last])
        out.append(((crc % np.uint32(buckets)).astype(np.int64), text[head]))
    return out, n_words


def _chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    yield from textwin.chunks(*textwin.buffers(batch.column(column)))


def bucket_counts(texts: DataFrame, text_col: str, max_run: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts; at most ``buckets`` rows leave a task."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, data, offs in _chunks(b, "_text"):
                for bucket, _ in bucket_runs(data, offs, max_run, buckets)[0]:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["_b", "_n"])

    rows = (texts.select(F.col(f"`{text_col}`").cast("string").alias("_text"))
            .mapInArrow(count, "_b long, _n long").groupBy("_b").agg(F.sum("_n").alias("_n"))
            .toArrow())                                     # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    out[rows["_b"].to_numpy()] = rows["_n"].to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed rates) per bucket."""
    k = len(corpus)
    s_all, t_all = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(
        float(t + 1) * float(s_all + k) / (float(s + 1) * float(t_all + k))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(seed: int, row_id: Column) -> Column:
    """1000 times a Gumbel variate from a hash of the seed and the id, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str,
          max_run: int, seed: int) -> DataFrame:
    """_id, _words, _features, _weight, _score per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)   # one number per bucket
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"),
                       F.col(f"`{text_col}`").cast("string").alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        gain = shared.value
        for b in batches:
            n = b.num_rows
            total, count, words = (np.zeros(n, np.int64) for _ in range(3))
            for lo, hi, data, offs in _chunks(b, "_text"):
                runs, n_words = bucket_runs(data, offs, max_run, len(gain))
                words[lo:hi] = n_words
                for bucket, text in runs:
                    count[lo:hi] += np.bincount(text, minlength=hi - lo)
                    # Sums per text as differences of a running sum: exact in integers.
                    upto = np.concatenate([[0], np.cumsum(gain[bucket])])
                    cut = np.searchsorted(text, np.arange(hi - lo + 1))
                    total[lo:hi] += upto[cut[1:]] - upto[cut[:-1]]
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(words), pa.array(count), pa.array(weight)],
                ["_id", "_words", "_features", "_weight"])

    weighed = rows.mapInArrow(run, f"_id {id_type}, _words long, _features long, _weight long")
    return weighed.withColumn("_score", F.col("_weight") + noise(seed, F.col("_id")))


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """A sorted frame with ``_rank`` from 1: a partition's offset plus the place in it."""
    table = written(ordered.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    sizes = table.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, seen = [], 0
    for r in sorted(sizes, key=lambda r: r._p):    # one row per partition of the sort
        offsets.append((r._p, seen))
        seen += r._n
    spark = ordered.sparkSession
    shift = spark.createDataFrame(offsets or [(0, 0)], "_p long, _before long")
    return table.join(F.broadcast(shift), part == F.col("_p")).withColumn(
        "_rank", F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop(
        "_p", "_before", "_place")


def draw(weighed: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``weighed`` (a written table) plus ``_rank``: 1, 2, ... for the drawn rows, else null."""
    able = F.col("_words") >= min_words
    # Integer scores: their range is that of the logarithms, whatever the number of rows.
    counts = weighed.where(able).groupBy("_score").agg(F.count(F.lit(1)).alias("_n")).collect()
    n_drawn = percent * sum(r._n for r in counts) // 100
    cut, above = None, 0
    for r in sorted(counts, key=lambda r: -r._score):
        if above >= n_drawn:
            break
        cut, above = r._score, above + r._n
    none = F.lit(None).cast("long")
    if cut is None:
        return weighed.withColumn("_rank", none)
    high = able & (F.col("_score") >= cut)
    ordered = weighed.where(high).orderBy(
        F.col("_score").desc(), F.col("_id").asc_nulls_last(), "_row")
    ranked = numbered(ordered, "importance-drawn").withColumn(
        "_rank", F.when(F.col("_rank") <= n_drawn, F.col("_rank")))
    return weighed.where(~high).withColumn("_rank", none).unionByName(ranked)


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text", target_text_col: str = "text",
                        buckets: int = 10000, max_run: int = 2, percent: int = 25,
                        min_words: int = 20, seed: int = 7) -> DataFrame:
    """id, n_words, n_features, weight, score and rank (null: not drawn) per row of ``docs``."""
    gains = bucket_gains(bucket_counts(docs, text_col, max_run, buckets),
                         bucket_counts(target, target_text_col, max_run, buckets))
    weighed = weigh(docs, gains, id_col, text_col, max_run, seed)
    weighed = written(weighed.withColumn("_row", F.monotonically_increasing_id()),
                      "importance-scores")
    return draw(weighed, percent, min_words).select(
        F.col("_id").alias(id_col), F.col("_words").alias("n_words"),
        F.col("_features").alias("n_features"), F.col("_weight").alias("weight"),
        F.col("_score").alias("score"), F.col("_rank").alias("rank"))


def drawn_documents(docs: DataFrame, resampled: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, whose id was drawn; ids must name rows."""
    ids = resampled.where(F.col("rank").isNotNull()).select(F.col(f"`{id_col}`").alias("_drawn"))
    return docs.join(ids, F.col(f"`{id_col}`") == F.col("_drawn"), "left_semi")
