"""Suffix-array dedup on bytes: remove what a 400-byte string elsewhere repeats.

*Candidates.* A ``window``-byte string is represented by its anchor, the 128 bytes in it
with the smallest hash.  Equal strings have equal anchors at equal places, so strings
whose anchor hash occurs at one place only cannot repeat; nothing is lost, and one row
per 137 bytes tells.  Only documents that hold a repeated anchor go on.

*Shards.* Each run of candidate strings with one anchor is a piece of text (the run's
strings, whole), dealt by the anchor's hash: equal strings meet in one shard.  Pieces
equal within an Arrow batch are settled there and sent once, and those equal within a
shard are settled before its suffix arrays.

*Suffix arrays.* A task takes the pieces of its anchors, about ``SHARD`` bytes at a
time, and builds their suffix array by induced sorting (``sais``): suffixes are
classified by type, leftmost-smaller substrings are sorted recursively, and the shard's
array is induced in linear passes.  Permuted common prefixes then tell which strings share ``window``
bytes with a neighbour in the order: those repeat.

*Hot anchors.* An anchor with more than ``HOT`` pieces (a passage in many documents:
its inner pieces are equal and settled, but those at its two ends all differ) would
make one shard grow with the input.  Its strings are compared singly instead, dealt by
a 96-bit hash of each.  This is a split, not a limit: all strings are compared.

Every step is a written table in the shared folder or a spilling sort.  Memory per
task: one Arrow batch, one shard's arrays, or one text.

Defined results: null text = empty; texts shorter than the window keep all bytes; rows
equal in id and text are each other's copies; an empty table gives no rows; other
columns are not read.  Removed bytes may cut code points; digests are over bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import repeats, sais, textwin
from stratum.llm.common import keyed, same_row, written

GRAM = 128
SHARD = 1 << 20        # bytes of pieces per suffix array
HOT = 512              # pieces of one anchor that are still one shard's
BROADCAST_ROWS = 1 << 17


def _chunk_minima(data, offs, window, gram):
    """(gram hashes, minimum per string, whether the string stays in its text)."""
    total = textwin.running(data)
    h = textwin.byte_hash(total, gram)
    width = window - gram + 1
    low = textwin.sliding_min(h, width)
    ok = np.zeros(len(low), bool)
    for a, b in zip(offs[:-1], offs[1:]):
        if b - a >= window:
            ok[a:b - window + 1] = True
    return h, low, ok


def _anchor_rows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    id_type = rows.schema["_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = textwin.buffers(b.column("_text"))
            keys, owner = [np.empty(0, textwin.U)], [np.empty(0, np.int64)]
            for i, _, part, po in textwin.chunks(data, offs):
                h, low, ok = _chunk_minima(part, po, window, gram)
                place = textwin.anchors(h, low, ok, window - gram + 1)
                keys.append(h[place])
                owner.append(np.searchsorted(po, place, "right") - 1 + i)
            key, row = np.concatenate(keys), np.concatenate(owner)
            if len(key):
                yield repeats.emit(b.column("_id"), b.column("_tk"), key,
                                   np.zeros(len(key), np.int32), row, key.view(np.int64), False)

    return rows.mapInArrow(emit, repeats.rows_schema(id_type))


PIECE = ("_v long, _id {0}, _tk long, _kind byte, _at int, _n int, _twice boolean, "
         "_piece binary")


def _pieces(table: DataFrame, window: int, gram: int) -> DataFrame:
    """Pieces of the candidate strings; equal ones of a batch as KNOWN and one WITNESS."""
    id_type = table.schema["_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, tks, found = b.column("_id"), b.column("_tk"), b.column("_found")
            data, offs = textwin.buffers(b.column("_text"))
            v, row, at, n, twice, piece = [], [], [], [], [], []
            for i, j, part, po in textwin.chunks(data, offs):
                h, low, ok = _chunk_minima(part, po, window, gram)
                for k in range(i, j):
                    a, e = po[k - i], max(po[k - i], po[k - i + 1] - window + 1)
                    if e <= a:
                        continue
                    lo, hi = found.offsets[k].as_py(), found.offsets[k + 1].as_py()
                    own = found.values.slice(lo, hi - lo).field("_at").to_numpy(
                        zero_copy_only=False).view(textwin.U)
                    mine = low[a:e]
                    cut = np.flatnonzero(mine[1:] != mine[:-1]) + 1
                    first, last = np.append(0, cut), np.append(cut, len(mine))
                    good = np.isin(mine[first], own)
                    raw = part[a:po[k - i + 1]].tobytes()
                    for s, t, x in zip(first[good], last[good], mine[first[good]]):
                        v.append(x.view(np.int64)), row.append(k), at.append(s), n.append(t - s)
                        # Whether the anchor stands in the piece twice (it may repeat itself).
                        twice.append(np.count_nonzero(
                            h[a + s:a + t + window - gram] == x) > 1)
                        piece.append(raw[s:t + window - 1])
            seen: dict[bytes, int] = {}
            mark = [hashlib.blake2b(p, digest_size=16).digest() for p in piece]
            for m in mark:
                seen[m] = seen.get(m, 0) + 1
            kind = np.array([repeats.SINGLE if seen[m] == 1 else repeats.KNOWN for m in mark],
                            np.int8)
            witness, told = [], set()
            for i, m in enumerate(mark):
                if seen[m] > 1 and m not in told:
                    told.add(m)
                    witness.append(i)
            w = len(witness)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(v + [v[i] for i in witness], np.int64)),
                 pa.concat_arrays([ids.take(pa.array(row, pa.int64())), pa.nulls(w, ids.type)]),
                 pa.concat_arrays([tks.take(pa.array(row, pa.int64())), pa.nulls(w, tks.type)]),
                 pa.array(np.concatenate([kind, np.full(w, repeats.WITNESS, np.int8)])),
                 pa.array(np.array(at + [at[i] for i in witness], np.int32)),
                 pa.array(np.array(n + [n[i] for i in witness], np.int32)),
                 pa.array(twice + [twice[i] for i in witness], pa.bool_()),
                 pa.array([p if k == repeats.SINGLE else None for p, k in zip(piece, kind)]
                          + [piece[i] for i in witness], pa.binary())],
                ["_v", "_id", "_tk", "_kind", "_at", "_n", "_twice", "_piece"])

    return table.mapInArrow(emit, PIECE.format(id_type))


def repeated_starts(pieces: list[bytes], window: int) -> list[np.ndarray]:
    """Per piece, the starts of strings that occur again among the pieces."""
    size = np.array([len(p) for p in pieces])
    s = np.zeros(int(size.sum()) + len(pieces) + 1, np.uint16)
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    base = np.cumsum(np.append(0, size + 1))           # one separator after each piece
    body = np.ones(len(s), bool)
    body[base[1:] - 1] = False
    body[-1] = False
    s[body] = flat.astype(np.uint16) + 2
    s[base[1:] - 1] = 1
    sa = sais.suffix_array(s, 258)
    phi, lcp = sais.permuted_lcp(s, sa, window)
    hit = np.flatnonzero(lcp >= window)
    again = np.zeros(len(s), bool)
    again[hit] = True
    again[phi[hit]] = True
    # A string that runs over its piece's end is none: separators match each other.
    return [np.flatnonzero(again[b:b + max(0, n - window + 1)]) for b, n in zip(base, size)]


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(starts):
        return starts, starts
    first = np.flatnonzero(np.append(True, starts[1:] != starts[:-1] + 1))
    return starts[first], np.diff(np.append(first, len(starts)))


FOUND = "_id {0}, _tk long, _at long, _n int"


def _by_suffix_arrays(cold: DataFrame, window: int) -> DataFrame:
    id_type = cold.schema["_id"].dataType.simpleString()

    def found(rows: list[tuple], types) -> pa.RecordBatch:
        ids, tks, at, n = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, types), pa.array(tks, pa.int64()), pa.array(at, pa.int64()),
             pa.array(n, pa.int32())], ["_id", "_tk", "_at", "_n"])

    def judge(held: list[tuple], out: list[tuple]) -> None:
        for (i, tk, start, _, _), starts in zip(held, repeated_starts([x[4] for x in held],
                                                                      window)):
            if tk is not None:
                out.extend((i, tk, start + int(a), int(k)) for a, k in zip(*_runs(starts)))

    def settle(group: list[tuple], held: list[tuple], out: list[tuple]) -> None:
        """One anchor's pieces: equal ones repeat whole; distinct ones go to the array."""
        by: dict[bytes, list[tuple]] = {}
        for x in group:
            by.setdefault(x[4], []).append(x)
        alone = len(by) == 1
        for piece, own in by.items():
            i, tk, start, twice, _ = own[0]
            if len(own) > 1 or tk is None:     # a witness stands for two
                out.extend((x[0], x[1], x[2], len(piece) - window + 1)
                           for x in own if x[1] is not None)
                tk = None
            if not alone or (twice and tk is not None):
                held.append((i, tk, start, twice, piece))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, out, last, types, seen = [], [], [], None, None, 0
        for b in batches:
            types = b.column("_id").type
            for v, *x in zip(*[b.column(c).to_pylist() for c in (
                    "_v", "_id", "_tk", "_at", "_twice", "_piece")]):
                if group and v != last:
                    have = len(held)
                    settle(group, held, out)
                    group = []
                    seen += sum(len(y[4]) for y in held[have:])
                    if seen >= SHARD:
                        judge(held, out)
                        held, seen = [], 0
                    if len(out) > 10_000:
                        yield found(out, types)
                        out = []
                group.append(tuple(x))
                last = v
        if group:
            settle(group, held, out)
        if held:
            judge(held, out)
        if out:
            yield found(out, types)

    dealt = cold.repartition("_v").sortWithinPartitions("_v")
    return dealt.select("_v", "_id", "_tk", "_at", "_twice", "_piece").mapInArrow(
        run, FOUND.format(id_type))


def _by_hash(hot: DataFrame, window: int) -> DataFrame:
    """The strings of hot anchors, each under its own hash."""
    id_type = hot.schema["_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = textwin.buffers(b.column("_piece"))
            start = b.column("_at").to_numpy()
            lone = ~b.column("_tk").is_null().to_numpy(zero_copy_only=False)
            key, key2, row, at = [], [], [], []
            one, two = textwin.running(data), textwin.running(data, 77)
            h1, h2 = textwin.byte_hash(one, window), textwin.byte_hash(two, window)
            for k in range(b.num_rows):
                p = np.arange(offs[k], offs[k + 1] - window + 1)
                for _ in range(1 if lone[k] else 2):     # a witness stands for two
                    key.append(h1[p])
                    key2.append((h2[p] >> textwin.U(32)).astype(np.uint32).view(np.int32))
                    row.append(np.full(len(p), k))
                    at.append(p - offs[k] + start[k])
            if key:
                yield repeats.emit(b.column("_id"), b.column("_tk"),
                                   *(np.concatenate(x) for x in (key, key2, row, at)), True)

    rows = hot.select("_id", "_tk", "_at", "_piece").mapInArrow(
        emit, repeats.rows_schema(id_type))
    return repeats.repeated_rows(rows).where("_tk IS NOT NULL")


def suffix_dedup(docs: DataFrame, window: int = 400, id_col: str = "doc_id",
                 text_col: str = "text", with_bytes: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept`` bytes where some went)."""
    gram = min(GRAM, max(1, window // 2))
    rows = keyed(docs, id_col, text_col)
    id_type = rows.schema["_id"].dataType.simpleString()
    marked = repeats.repeated(_anchor_rows(rows, window, gram))
    t, f = rows.alias("t"), marked.alias("f")
    table = written(t.join(f, same_row("t", "f")).select("t.*", "f._found"), "suffix-candidates")
    pieces = written(_pieces(table, window, gram), "suffix-pieces")
    known = pieces.where(f"_kind = {repeats.KNOWN}").select(
        "_id", "_tk", F.col("_at").cast("long").alias("_at"), "_n")
    open_ = pieces.where(f"_kind <> {repeats.KNOWN}")
    hot = written(open_.groupBy("_v").agg(F.count(F.lit(1)).alias("_k"))
                  .where(F.col("_k") > HOT).select("_v"), "suffix-hot")
    side = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    found = (known.unionByName(_by_suffix_arrays(open_.join(side, "_v", "left_anti"), window))
             .unionByName(_by_hash(open_.join(side, "_v", "left_semi"), window)))
    found = repeats.per_holder(found)
    c = table.select("_id", "_tk", "_text").alias("c")
    hit = c.join(found.alias("f"), same_row("c", "f")).select("c.*", "f._found")
    out = (f"_id {id_type}, _tk long, n_bytes long, n_removed long, n_spans long, "
           "kept_sha256 string, kept binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("_found") if "_found" in b.schema.names else None
            data, offs = textwin.buffers(b.column("_text"))
            n, gone_n, spans, sha, kept = [], [], [], [], []
            for i in range(b.num_rows):
                raw = data[offs[i]:offs[i + 1]]
                rest, g, sp = raw, 0, 0
                if lists is not None:
                    gone = repeats.marks(lists, i, len(raw), window)
                    rest, g = raw[~gone], int(gone.sum())
                    sp = int(np.count_nonzero(gone & ~np.append(False, gone[:-1])))
                rest = rest.tobytes()
                n.append(len(raw)), gone_n.append(g), spans.append(sp)
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_bytes and lists is not None else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_tk"), *[pa.array(x, pa.int64()) for x in
                                                     (n, gone_n, spans)],
                 pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                ["_id", "_tk", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    # Rows equal in id and text were cut alike: one of them is enough to join.
    cols = ["n_removed", "n_spans", "kept_sha256", *(["kept"] if with_bytes else [])]
    changed = hit.mapInArrow(cut, out).groupBy("_id", "_tk").agg(
        *[F.max(x).alias(x) for x in cols])
    b, r = rows.mapInArrow(cut, out).drop("kept").alias("b"), changed.alias("r")
    last = [F.col("r.kept")] if with_bytes else []
    return b.join(r, same_row("b", "r"), "left").select(
        F.col("b._id").alias(id_col), "b.n_bytes",
        *[F.coalesce(f"r.{x}", f"b.{x}").alias(x) for x in ("n_removed", "n_spans",
                                                            "kept_sha256")], *last)
