import hashlib
import re
from collections import Counter

import pytest

from llm_corpus import corpus, frame, with_clashes
from stratum.llm.substring_dedup import levels, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k:k + window]) for _, w in texts for k in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:4])


@pytest.mark.parametrize("window", [35, 9, 20])
def test_against_brute_force(spark, window):
    rows = corpus()
    got = substring_dedup(frame(spark, rows), window=window).collect()
    assert sorted(map(tuple, got)) == sorted(r[:4] for r in brute(rows, window))


def test_odd_ids_repeated_rows_and_clashing_columns(spark):
    rows = corpus(2, 40)
    rows += rows[10:20] + [(None, " ".join(f"q{i}" for i in range(50)))] * 2 + [(3, "other text")]
    df = with_clashes(frame(spark, rows))
    got = [tuple(r) for r in substring_dedup(df).collect()]
    assert sorted(got, key=key) == sorted((r[:4] for r in brute(rows, 35)), key=key)


def test_text_output_and_empty_table(spark):
    rows = corpus(3, 40)
    got = {r.doc_id: r for r in substring_dedup(frame(spark, rows), with_text=True).collect()}
    for i, _, gone, _, kept in brute(rows, 35):
        assert got[i].kept_text == (kept if gone else got[i].kept_text)
        assert got[i].n_removed == gone
    assert substring_dedup(frame(spark, rows).limit(0)).count() == 0


def test_levels_double_up_to_the_window():
    assert levels(35) == [9, 18, 35]
    assert levels(8) == [8]
