import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_corpus import corpus, frame, with_clashes
from stratum.llm import sais, suffix_dedup as sd


def brute(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + window] for _, b in texts for k in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if seen[b[k:k + window]] > 1:
                gone[k:k + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("window,hot", [(400, 512), (60, 512), (60, 3)])
def test_against_brute_force(spark, monkeypatch, window, hot):
    monkeypatch.setattr(sd, "HOT", hot)   # read on the driver
    rows = [(i, t if t is None else t[:6000]) for i, t in corpus(1, 100)]
    got = sd.suffix_dedup(frame(spark, rows), window=window).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, window))


def test_odd_rows(spark):
    rows = [(i, t if t is None else t[:3000]) for i, t in corpus(2, 30)]
    rows += rows[5:12] + [(None, "null id " * 80)] * 2 + [(3, "other")]
    got = sd.suffix_dedup(with_clashes(frame(spark, rows))).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 400), key=key)
    assert sd.suffix_dedup(frame(spark, rows).limit(0)).count() == 0


def test_kept_bytes(spark):
    rows = [(1, "a" * 900), (2, "b" * 399), (3, "c" * 399 + "d" * 400), (4, "x" + "d" * 400)]
    got = {r.doc_id: r for r in sd.suffix_dedup(frame(spark, rows), with_bytes=True).collect()}
    assert got[1].n_removed == 900 and bytes(got[1].kept) == b""
    assert got[2].n_removed == 0 and got[2].kept is None
    assert bytes(got[3].kept) == b"c" * 399 and bytes(got[4].kept) == b"x"


def test_suffix_arrays_and_common_prefixes(monkeypatch):
    rng = random.Random(1)
    for trial in range(200):
        monkeypatch.setattr(sais, "DENSE", rng.choice([0, 1, 8, 10**9]))
        k = rng.choice([1, 2, 3, 20])
        t = [rng.randrange(1, k + 1) for _ in range(rng.randrange(1, 120))] + [0]
        s = np.array(t, np.uint16)
        order = sorted(range(len(t)), key=lambda i: t[i:])
        sa = sais.suffix_array(s, k + 1)
        assert sa.tolist() == order
        phi, lcp = sais.permuted_lcp(s, sa, 1000)
        for a, b in zip(order, order[1:]):
            n = 0
            while t[a + n] == t[b + n]:
                n += 1
            assert phi[b] == a and lcp[b] == n


def test_recursion_runs_on_a_megabyte_of_prose(monkeypatch):
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"]
    raw, k = b"", 0
    while len(raw) < 1 << 20:
        raw, k = raw + (texts[k].as_py() or "").encode() + b"\n", k + 1
    raw = raw[:1 << 20]
    s = np.append(np.frombuffer(raw, np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16)
    levels = []
    real = sais.suffix_array

    def counted(t, sigma):
        levels.append((len(t), sigma))
        return real(t, sigma)

    monkeypatch.setattr(sais, "suffix_array", counted)
    sa = sais.suffix_array(s, 257)
    assert len(levels) >= 3 and levels[1][1] > 4096          # names beyond any small alphabet
    assert np.array_equal(np.sort(sa), np.arange(len(s)))
    text = raw + b"\0"
    for i in np.random.RandomState(1).randint(1, len(s) - 1, 30000):
        assert text[sa[i]:sa[i] + 30000] <= text[sa[i + 1]:sa[i + 1] + 30000]


def test_repeated_starts_do_not_cross_pieces():
    a, b = b"abcdefgh" * 3, b"abcdefgh"
    got = sd.repeated_starts([a, b, b"zz", b"ghab"], 4)
    assert got[0].tolist() == list(range(21)) and got[1].tolist() == list(range(5))
    assert got[2].tolist() == [] and got[3].tolist() == [0]
