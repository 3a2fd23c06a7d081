"""Vectorised word and window hashing over Arrow text columns (NumPy, inside tasks).

Texts are taken as bytes, a chunk of whole texts at a time, so memory follows the
chunk (or the longest text) and not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 1 << 21  # bytes of text worked on at once

_rng = np.random.RandomState(20240229)
BYTE_VALUE = _rng.randint(1, 1 << 62, 256).astype(U) * U(2) + U(1)
BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True
# Letters, digits and all bytes of longer code points make words; the rest separates.
PUNCT = np.ones(256, bool)
PUNCT[48:58] = PUNCT[65:91] = PUNCT[97:123] = PUNCT[128:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < n (kept for the next call)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 12)
        out = np.empty(size, U)
        out[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            out[done:done + step] = out[:step] * U(pow(base, done, 1 << 64))
            done += step
        _powers[base] = have = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(0xD6E8FEB86659FD93) + b)


def window_hash(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` items, by doubling."""
    if len(h) < length:
        return h[:0]
    cur, size = h, 1
    while size * 2 <= length:
        cur = combine(cur[:-size], cur[size:])
        size *= 2
    if size < length:
        d = length - size
        cur = combine(cur[:-d], cur[d:])
    return cur


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    cur, size = x, 1
    while size * 2 <= width:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    if size < width:
        d = width - size
        cur = np.minimum(cur[:-d], cur[d:])
    return cur


def anchors(h: np.ndarray, low: np.ndarray, ok: np.ndarray, width: int) -> np.ndarray:
    """Places of ``h`` that are the minimum of some window i with ``ok[i]``.

    ``low``: the minima of all ``width`` neighbours.  No window over a place has a
    minimum above its value, so the place is one exactly if the largest equals it.
    """
    if not len(low):
        return np.empty(0, np.int64)
    edge = np.zeros(width - 1, U)
    held = np.where(ok, low, U(0))
    most = ~sliding_min(~np.concatenate([edge, held, edge]), width)
    return np.flatnonzero((most == h) & (most > 0))


def byte_hash(total: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all ``length``-byte strings, from the running polynomial."""
    n = len(total) - length
    if n <= 0:
        return np.empty(0, U)
    return mix((total[length:] - total[:-length]) * powers(INVERSE, n) + U(length))


def running(data: np.ndarray, salt: int = 0) -> np.ndarray:
    """Running polynomial over bytes (``salt``: another independent one)."""
    value = BYTE_VALUE if not salt else mix(BYTE_VALUE + U(salt)) | U(1)
    total = np.empty(len(data) + 1, U)
    total[0] = 0
    np.cumsum(value[data] * powers(BASE, len(data)), out=total[1:])
    return total


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        empty = ""
    else:
        empty = b""
    if col.null_count:
        col = col.fill_null(empty)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(
        0, np.uint8)
    o = o.astype(np.int64)
    return raw[o[0]:o[-1]], o - o[0]


def chunks(data: np.ndarray, offs: np.ndarray,
           limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit``."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


@dataclass
class Words:
    starts: np.ndarray   # first byte of every word
    ends: np.ndarray     # byte after it
    hashes: np.ndarray   # 64-bit, by content
    first: np.ndarray    # first word of every text, and the end
    total: np.ndarray    # running polynomial over the bytes

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def prefixes(self, length: int) -> np.ndarray:
        """Hashes of every word's first ``length`` bytes, apart from those of words."""
        ends = np.minimum(self.starts + length, self.ends)
        h = (self.total[ends] - self.total[self.starts]) * powers(
            INVERSE, len(self.total))[self.starts]
        return mix(h + U(1 << 40) + U(length))

    def fits(self, n_windows: int, length: int) -> np.ndarray:
        """Whether window i (of ``length`` words) ends inside its text."""
        ends = np.repeat(self.first[1:], np.diff(self.first))[:n_windows]
        return np.arange(n_windows) + length <= ends


def words_of(data: np.ndarray, offs: np.ndarray, lower: bool = False,
             blank: np.ndarray = BLANK) -> Words:
    """The blank-separated words of each text."""
    buf = LOWER[data] if lower else data
    n = len(buf)
    if n == 0:
        z = np.empty(0, np.int64)
        return Words(z, z, np.empty(0, U), np.zeros(len(offs), np.int64),
                     np.zeros(1, U))
    solid = ~blank[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    before &= ~edge[:n]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    after &= ~edge[1:]
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    total = np.empty(n + 1, U)
    total[0] = 0
    np.cumsum(BYTE_VALUE[buf] * powers(BASE, n), out=total[1:])
    h = (total[ends] - total[starts]) * powers(INVERSE, n)[starts]
    h = mix(h + (ends - starts).astype(U))
    return Words(starts, ends, h, np.searchsorted(starts, offs), total)
