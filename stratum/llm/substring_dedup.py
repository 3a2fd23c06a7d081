"""Substring dedup on words, by level-wise doubling.

Every word covered by a window of ``window`` words that also starts anywhere else is
removed.  A window can only repeat where its parts repeat, so the levels are lengths
that double up to the window: 9, 18, 35 for a window of 35.  Windows repeated at one
level alone go to the next; with no candidate left, a level has nothing to do.

What a level shuffles: below the last, each window is represented by its *anchor*,
the part of the level's length with the smallest hash.  Equal windows have equal
anchors at equal places, so a window whose anchor hash occurs at one place only
cannot repeat: the filter loses nothing, and it needs about one row per 13 words at
the first level.  The last level compares the windows themselves, by 96-bit hashes
of what little is left.

Texts move twice: once whole, to meet the anchors of level 1, then only the documents
that still hold candidates.  The levels but the last two are written tables in the
shared folder, so a lost executor costs one level.  Keys settled within a batch do
not travel (``repeats``): a passage shared by a third of all documents reaches a task
once per batch.  Memory per task: one Arrow batch, and one text.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null or blank text has none and
keeps the empty string; texts shorter than the window keep all words; rows equal in
id and text are each other's copies; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import repeats, textwin
from stratum.llm.common import keyed, same_row, written

LEAST_LEVEL = 9


def levels(window: int, least: int = LEAST_LEVEL) -> list[int]:
    """Lengths that (nearly) double up to ``window``."""
    out = [window]
    while -(-out[0] // 2) >= least:
        out.insert(0, -(-out[0] // 2))
    return out


def _windows(data, offs, window, length, allowed):
    """Anchors (or the windows, at the last level) of the candidate windows of a chunk.

    ``allowed``: (previous level, per text the sorted repeated anchors) or None for all.
    Gives key, key2, text number and word position per candidate.
    """
    w = textwin.words_of(data, offs)
    n = max(0, len(w.hashes) - window + 1)
    ok = w.fits(n, window)
    text = w.text_of()[:n]
    if allowed is not None:
        below, lists = allowed
        prev = textwin.sliding_min(textwin.window_hash(w.hashes, below), window - below + 1)
        for i, own in enumerate(lists):
            lo, hi = w.first[i], min(w.first[i + 1], n)
            if hi > lo:
                ok[lo:hi] &= np.isin(prev[lo:hi], own)
    at = np.flatnonzero(ok)
    if length == window:
        key = textwin.window_hash(w.hashes, window)[at]
        other = textwin.window_hash(textwin.mix(w.hashes + textwin.U(0x5851F42D4C957F2D)), window)
        key2 = (other[at] >> textwin.U(32)).astype(np.uint32).view(np.int32)
        return key, key2, text[at], at - w.first[text[at]]
    h = textwin.window_hash(w.hashes, length)
    width = window - length + 1
    place = textwin.anchors(h, textwin.sliding_min(h, width), ok, width)
    return (h[place], np.zeros(len(place), np.int32), w.text_of()[place],
            h[place].view(np.int64))


def _level_rows(table: DataFrame, window: int, length: int, below: int | None) -> DataFrame:
    id_type = table.schema["_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tks = b.column("_id"), b.column("_tk")
            data, offs = textwin.buffers(b.column("_text"))
            lists = None if below is None else b.column("_found")
            parts = []
            for i, j, part, po in textwin.chunks(data, offs):
                allowed = None
                if lists is not None:
                    own = [lists.values.slice(lists.offsets[k].as_py(), lists.offsets[
                        k + 1].as_py() - lists.offsets[k].as_py()).field("_at").to_numpy(
                        zero_copy_only=False).view(textwin.U) for k in range(i, j)]
                    allowed = (below, own)
                key, key2, text, at = _windows(part, po, window, length, allowed)
                parts.append((key, key2, text + i, at.astype(np.int64)))
            if not parts:
                continue
            key, key2, row, at = (np.concatenate(x) for x in zip(*parts))
            if len(key):
                yield repeats.emit(ids, tks, key, key2, row, at, length == window)

    return table.mapInArrow(emit, repeats.rows_schema(id_type))


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id",
                    text_col: str = "text", with_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 (and ``kept_text`` where words went)."""
    rows = keyed(docs, id_col, text_col)
    lengths = levels(window)
    table, below = rows, None
    for k, length in enumerate(lengths[:-1]):
        found = repeats.repeated(_level_rows(table, window, length, below))
        t = base = table.select("_id", "_tk", "_text")
        table = t.alias("t").join(found.alias("f"), same_row("t", "f")).select("t.*", "f._found")
        below = length
        # The last of several levels stays in the final plan, where its shuffle of the
        # candidates' texts serves the removal as well.
        if k == 0 or k < len(lengths) - 2:
            table = written(table, f"substring-level-{length}")
            base = table.select("_id", "_tk", "_text")
    if len(lengths) == 1:
        base = rows
    found = repeats.repeated(_level_rows(table, window, window, below))
    hit = base.alias("c").join(found.alias("f"), same_row("c", "f")).select("c.*", "f._found")
    id_type = rows.schema["_id"].dataType.simpleString()
    out = f"_id {id_type}, _tk long, n_words long, n_removed long, kept_sha256 string, kept_text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("_found") if "_found" in b.schema.names else None
            texts = b.column("_text")
            n_words, n_gone, sha, kept_text = [], [], [], []
            for i in range(b.num_rows):
                words = texts[i].as_py().encode("utf-8").split()
                kept = words
                if lists is not None:
                    gone = repeats.marks(lists, i, len(words), window)
                    kept = [words[k] for k in np.flatnonzero(~gone)]
                joined = b" ".join(kept)
                n_words.append(len(words))
                n_gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(joined).hexdigest())
                kept_text.append(joined.decode("utf-8") if with_text and lists is not None
                                 else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_tk"), pa.array(n_words, pa.int64()),
                 pa.array(n_gone, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(kept_text, pa.string())],
                ["_id", "_tk", "n_words", "n_removed", "kept_sha256", "kept_text"])

    # Rows equal in id and text were cut alike: one of them is enough to join.
    changed = hit.mapInArrow(cut, out).groupBy("_id", "_tk").agg(
        *[F.max(x).alias(x) for x in ("n_removed", "kept_sha256", "kept_text")])
    b, r = rows.mapInArrow(cut, out).alias("b"), changed.alias("r")
    res = b.join(r, same_row("b", "r"), "left").select(
        F.col("b._id").alias(id_col), "b.n_words",
        F.coalesce("r.n_removed", "b.n_removed").alias("n_removed"),
        F.coalesce("r.kept_sha256", "b.kept_sha256").alias("kept_sha256"),
        F.col("r.kept_text").alias("kept_text"))
    return res if with_text else res.drop("kept_text")
