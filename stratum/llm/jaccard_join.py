"""N-gram Jaccard join: size-aware, heavy-light; returns link components.

Sets are the distinct word 5-grams of a text (lower-cased ASCII).  Two sets link when
|A n B| / |A u B| >= 0.8, that is when the overlap o has 9 o >= 4 (|A| + |B|).

*Small sets* (light): a pair of sizes (n, m) needs an overlap of at least
c = ceil(4 (n + m) / 9), so each set enumerates its subsets of every size c that a
partner's size can ask for, and two sets link exactly when they share one of theirs.
Per subset a star to its smallest set keeps all components, so no pairs are listed.

*Large sets* (heavy): inverted lists.  A linked partner holds at least 0.8 n of a set's
items, so a set of which more than 0.2 n items occur in no other set links to none: the
items that occur once are counted first, with a compact shuffle (sorted hash keys of a
few hundred sets at a time, about three bytes an item), and only the other sets are
listed.  A linked partner also shares one of the first n - ceil(0.8 n) + 1 items of a
set in any fixed order, so only those are listed; items that a bounded sample of
documents shows to be common come last (the order affects the work, never the result).
A pair whose sizes, counts of single items or places in the order rule a link out is
dropped; the others are verified on the two texts, item by item.

*The boundary* is the size at which the enumerated subsets (from the histogram of set
sizes) start to cost more than listing and verifying; sets next to it take both ways,
since a small set may link to a large one.

Groups of near copies would make quadratically many candidate pairs.  Rounds avoid
that: a round verifies, per list, a star from one pivot (the member made most of
common items: the original of a group of copies), and joins what links into
components.  Members that are in one component need no further comparison.  Rounds go
on while they leave a quarter fewer pairs open; what is left then, members of one list
in different components, is verified whole.  No candidate is dropped at any point.

Equal sets are one node of the graph (a copy is settled by its set's digest), and
equal sets of one Arrow batch list their items once, so a third of all rows being
copies adds a row per batch to a list.

Defined results: null or blank text: empty set, linked with nothing; texts of fewer
than five words: the whole sequence is the one item; a null id takes no part in
links, and its component is null; rows that share an id are one node, whose
component holds the links of each; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm import textwin
from stratum.llm.common import written
from stratum.llm.components import components

NGRAM = 5
# Jaccard num / den; the overlap test is o * (num + den) >= num * (n + m).
NUM, DEN = 4, 5
MAX_SMALL = 14          # no subsets are enumerated beyond this size
LIST_COST = 6           # cost of listing and verifying one item, in subsets
SAMPLE_DOCS = 20_000    # documents that tell which items are common (order only)
COMMON_ITEMS = 1 << 20  # bound on the broadcast list of common items
PACK = 255              # sets whose items are counted together
BUCKET_ITEMS = 1 << 22  # items of one counting group, about
MAX_ROUNDS = 8


def least_overlap(n: int, m: int) -> int:
    return -(-NUM * (n + m) // (NUM + DEN))


def subset_sizes(n: int) -> list[int]:
    """Overlaps that a linked partner of a set of ``n`` can need, up to ``n``."""
    lo, hi = -(-NUM * n // DEN), DEN * n // NUM
    return sorted({c for m in range(lo, hi + 1) if (c := least_overlap(n, m)) <= min(n, m)})


def prefix_length(n):
    return n - -(-NUM * n // DEN) + 1


def boundary(histogram: dict[int, int]) -> int:
    """The largest size handled by subsets, by total cost."""
    best, best_cost = 0, None
    for x in range(0, MAX_SMALL + 1):
        light = sum(k * sum(comb(n, c) for c in subset_sizes(n))
                    for n, k in histogram.items() if n <= x)
        heavy = sum(k * LIST_COST * prefix_length(n) for n, k in histogram.items()
                    if n >= listed_from(x))
        if best_cost is None or light + heavy < best_cost:
            best, best_cost = x, light + heavy
    return best


def listed_from(x: int) -> int:
    """Smallest size that may link to a size above ``x``."""
    return max(1, -(-NUM * (x + 1) // DEN))


def sets_of(data: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct item hashes of each text."""
    w = textwin.words_of(data, offs, lower=True)
    grams = textwin.window_hash(w.hashes, NGRAM)
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= NGRAM:
            yield np.unique(grams[a:b - NGRAM + 1])
        elif b > a:
            yield textwin.window_hash(w.hashes[a:b], int(b - a)) + textwin.U(b - a)
        else:
            yield np.empty(0, textwin.U)


def batch_sets(batch: pa.RecordBatch, column: str) -> Iterator[np.ndarray]:
    data, offs = textwin.buffers(batch.column(column))
    for _, _, part, po in textwin.chunks(data, offs):
        yield from sets_of(part, po)


def digest(items: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
    return (int.from_bytes(raw[:8], "big", signed=True),
            int.from_bytes(raw[8:], "big", signed=True))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """|a n b| of sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _batch(cols: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def set_digests(rows: DataFrame) -> DataFrame:
    """_id, _n, digest and, for small sets, the items."""
    def run(batches):
        for b in batches:
            n, d1, d2, small = [], [], [], []
            for s in batch_sets(b, "_text"):
                x, y = digest(s)
                n.append(len(s)), d1.append(x), d2.append(y)
                small.append(s.view(np.int64).tolist() if 0 < len(s) <= MAX_SMALL else None)
            yield _batch({"_id": b.column("_id"), "_n": pa.array(n, pa.int64()),
                          "_d1": pa.array(d1, pa.int64()), "_d2": pa.array(d2, pa.int64()),
                          "_items": pa.array(small, pa.list_(pa.int64()))})
    return rows.mapInArrow(run, "_id long, _n long, _d1 long, _d2 long, _items array<long>")


def small_links(sets: DataFrame, x: int) -> DataFrame:
    """Links (a, b) among sets (_id, _items) of at most ``x`` items, by shared subsets."""
    def run(batches):
        for b in batches:
            out = []
            for i, items in zip(b.column("_id").to_pylist(), b.column("_items").to_pylist()):
                for c in subset_sizes(len(items)):
                    for pick in combinations(items, c):
                        h = hashlib.blake2b(np.array(pick, np.int64).tobytes(), digest_size=8)
                        out.append((int.from_bytes(h.digest(), "big", signed=True), c,
                                    len(items), i))
            k, c, n, d = zip(*out) if out else ((), (), (), ())
            yield _batch({"_key": pa.array(k, pa.int64()), "_c": pa.array(c, pa.int32()),
                          "_n": pa.array(n, pa.int32()), "_id": pa.array(d, pa.int64())})
    small = sets.where(f"_n BETWEEN 1 AND {x}").select("_id", "_items")
    subs = written(small.mapInArrow(run, "_key long, _c int, _n int, _id long"), "subsets")
    star = subs.groupBy("_key", "_c").agg(F.min(F.struct("_n", "_id")).alias("_s"),
                                          F.count(F.lit(1)).alias("_k")).where("_k > 1")
    # A set that cannot link to the smallest holder of a subset links to none through it.
    return (subs.join(star, ["_key", "_c"])
            .where(f"_id <> _s._id AND _c * {NUM + DEN} >= {NUM} * (_n + _s._n)")
            .select(F.col("_s._id").alias("a"), F.col("_id").alias("b")).distinct())


# ---- items that occur in one set only ----------------------------------------------

def _packed(sets: list[np.ndarray], marks: list[int], key_bits: int, n_buckets: int) -> list[tuple]:
    """(bucket, keys, places, digests) rows of some sets: sorted keys as differences, in two
    16-bit planes, and for each the place of its set (``PACK``: in several)."""
    key = np.concatenate(sets) >> np.uint64(64 - key_bits)
    place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order].astype(np.uint8)
    head = np.append(True, key[1:] != key[:-1])
    place[np.append(~head[1:], False)] = PACK          # the next one has the same key
    key, place = key[head], place[head]
    span = -(-(1 << key_bits) // n_buckets)
    cut = np.searchsorted(key, np.array([b * span for b in range(n_buckets)], np.uint64))
    cut = np.append(cut, len(key))
    who = np.array(marks, np.int64).tobytes()
    out = []
    for b in range(n_buckets):
        k = key[cut[b]:cut[b + 1]]
        if len(k):
            step = np.diff(np.append(np.uint64(b * span), k)).astype(np.uint32)
            planes = (step & np.uint32(0xFFFF)).astype(np.uint16).tobytes() + (
                step >> np.uint32(16)).astype(np.uint16).tobytes()
            out.append((b, planes, place[cut[b]:cut[b + 1]].tobytes(), who))
    return out


def single_items(rows: DataFrame, total: int) -> DataFrame:
    """_d1 (digest) and _single: how many items of the set are in no other set.

    Keys are hashes cut to a few bits more than the number of items needs, so an item
    may wrongly count as shared (which costs work), never as single.
    """
    key_bits = min(56, max(24, total.bit_length() + 5))
    n_buckets = max(1, total // BUCKET_ITEMS)

    def pack(batches):
        def flush():
            r = _packed(sets, marks, key_bits, n_buckets)
            sets.clear(), marks.clear()
            b, k, p, w = zip(*r)
            return _batch({"_bucket": pa.array(b, pa.int32()), "_keys": pa.array(k, pa.binary()),
                           "_places": pa.array(p, pa.binary()), "_who": pa.array(w, pa.binary())})
        for b in batches:
            sets, marks = [], []
            for s in batch_sets(b, "_text"):
                if len(s):
                    sets.append(s), marks.append(digest(s)[0])
                if len(sets) == PACK:
                    yield flush()
            if sets:
                yield flush()

    def count(table: pa.Table) -> pa.Table:
        keys, owner, who = [], [], []
        for k, p, w in zip(*[table.column(c).to_pylist() for c in ("_keys", "_places", "_who")]):
            n = len(p)
            lo, hi = np.frombuffer(k, np.uint16, n), np.frombuffer(k, np.uint16, n, 2 * n)
            keys.append(np.cumsum(lo.astype(np.int64) + (hi.astype(np.int64) << 16)))
            place = np.frombuffer(p, np.uint8).astype(np.int64)
            owner.append(np.where(place == PACK, -1, place + sum(map(len, who))))
            who.append(np.frombuffer(w, np.int64))
        key, own, ids = np.concatenate(keys), np.concatenate(owner), np.concatenate(who)
        order = np.argsort(key, kind="stable")
        k = key[order]
        edge = np.concatenate([[True], k[1:] != k[:-1], [True]])
        lone = own[order][edge[:-1] & edge[1:]]
        n = np.bincount(lone[lone >= 0], minlength=len(ids)).astype(np.int32)
        ends = np.cumsum([len(w) for w in who])
        return pa.table({"_who": table.column("_who"), "_counts": pa.array(
            [x.tobytes() for x in np.split(n, ends[:-1])], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        ids = np.frombuffer(table.column("_who")[0].as_py(), np.int64)
        n = sum(np.frombuffer(c.as_py(), np.int32).astype(np.int64)
                for c in table.column("_counts"))
        return pa.table({"_d1": pa.array(ids[n > 0]), "_single": pa.array(n[n > 0])})

    packs = rows.mapInArrow(pack, "_bucket int, _keys binary, _places binary, _who binary")
    counts = packs.groupBy("_bucket").applyInArrow(count, "_who binary, _counts binary")
    # One row per pack and bucket comes back, and one per set leaves.
    return counts.groupBy("_who").applyInArrow(add, "_d1 long, _single long").groupBy("_d1").agg(
        F.min("_single").alias("_single"))


def common_items(rows: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Items that repeat in a bounded sample of documents, with their frequency there."""
    share = min(1.0, SAMPLE_DOCS / max(1, n_docs))
    pick = rows.where(F.pmod(F.xxhash64(F.lit(3), "_id"), F.lit(1 << 20))
                      < int(share * (1 << 20)) + 1)

    def run(batches):
        for b in batches:
            parts = list(batch_sets(b, "_text"))
            items, count = np.unique(np.concatenate(parts), return_counts=True) if parts else (
                np.empty(0, textwin.U), np.empty(0, np.int64))
            yield _batch({"_item": pa.array(items.view(np.int64)), "_k": pa.array(
                count.astype(np.int64))})
    counts = pick.mapInArrow(run, "_item long, _k long").groupBy("_item").agg(
        F.sum("_k").alias("_k")).where("_k > 1")
    top = counts.orderBy(F.col("_k").desc(), "_item").limit(COMMON_ITEMS).toArrow()
    items = top["_item"].to_numpy().view(textwin.U)
    freq = top["_k"].to_numpy()
    order = np.argsort(items)
    return items[order], freq[order]


def listed_items(rows: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Inverted-list rows of the sets' first items: _item, _id, _n, _most (items that may
    be shared), _at (place in the order), _common (share of common items, per mille)."""
    shared = rows.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        items, freq = shared.value
        bits = np.zeros(1 << 22, bool)     # most items are not common: test a bit first
        bits[(items >> textwin.U(42)).astype(np.int64)] = True
        for b in batches:
            ids = b.column("_id").to_numpy(zero_copy_only=False)
            most = b.column("_most").to_numpy(zero_copy_only=False)
            out = []
            for i, s in enumerate(batch_sets(b, "_text")):
                n = len(s)
                rank = np.zeros(n, np.int64)
                if len(items):
                    maybe = np.flatnonzero(bits[(s >> textwin.U(42)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(items, s[maybe]), len(items) - 1)
                    hit = items[at] == s[maybe]
                    rank[maybe[hit]] = freq[at[hit]]
                p = prefix_length(n)
                order = np.lexsort((s, rank))[:p]
                share = int(1000 * np.count_nonzero(rank) / max(1, n))
                out.append((s[order].view(np.int64), ids[i], n, most[i], share, len(order)))
            if not out:
                continue
            t, d, n, m, c, p = zip(*out)
            rep = lambda x, k: pa.array(np.repeat(np.array(x, k), p))
            yield _batch({"_item": pa.array(np.concatenate(t)), "_id": rep(d, np.int64),
                          "_n": rep(n, np.int32), "_most": rep(m, np.int32),
                          "_at": pa.array(np.concatenate([np.arange(k, dtype=np.int32)
                                                          for k in p])),
                          "_common": rep(c, np.int32)})
    return rows.mapInArrow(run, "_item long, _id long, _n int, _most int, _at int, _common int")


def may_link(u: str, v: str) -> str:
    """SQL: two list rows (prefixes ``u``, ``v``) can belong to linked sets.

    At the first item of the order that both hold, what either has from there on
    bounds the overlap; at later ones the test may fail, which loses no pair.
    """
    left = f"least({u}_n - {u}_at, {v}_n - {v}_at, {u}_most, {v}_most)"
    return f"{left} * {NUM + DEN} >= {NUM} * ({u}_n + {v}_n)"


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their texts; ``a`` may be a hub."""
    b = texts.select(F.col("_id").alias("b"), F.col("_text").alias("_tb"))
    a = texts.select(F.col("_id").alias("a"), F.col("_text").alias("_ta"))
    both = pairs.select("a", "b").join(b, "b").join(a, "a")

    def run(batches):
        last, held = None, None
        for x in batches:
            ta = x.column("_ta")
            # Rows come sorted by a within a task: its set is made once per run.
            ca, cb = x.column("a").to_numpy(), x.column("b").to_numpy()
            ok = np.zeros(x.num_rows, bool)
            for i, sb in enumerate(batch_sets(x, "_tb")):
                text = ta[i].as_py()
                if text != last:
                    last = text
                    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                    held = next(sets_of(raw, np.array([0, len(raw)])))
                o = overlap(held, sb)
                ok[i] = o > 0 and o * (NUM + DEN) >= NUM * (len(held) + len(sb))
            yield _batch({"a": pa.array(ca[ok]), "b": pa.array(cb[ok])})
    return both.mapInArrow(run, "a long, b long")


LIST = ["_item", "_id", "_n", "_most", "_at", "_common"]


def large_links(rows: DataFrame, sets: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Links that join all components among the listed sets.

    ``sets``: the digests of all rows; ``classes``: one row per distinct set with its
    ``_rep``, the id that stands for it.
    """
    n_docs, total = sets.agg(F.count(F.lit(1)), F.sum("_n")).first()
    single = single_items(rows, int(total or 0))
    most = F.col("_n") - F.coalesce(F.col("_single"), F.lit(0))
    open_ = (classes.where(F.col("_n") >= least).join(single, "_d1", "left")
             .where(most >= F.ceil(F.col("_n") * NUM / DEN))
             .groupBy(F.col("_rep").alias("_id")).agg(F.max(most).alias("_most")))
    open_ = written(open_, "open-sets")
    common = common_items(rows, n_docs)
    texts = rows.join(open_, "_id").groupBy("_id", "_most", F.xxhash64("_text").alias("_tk")).agg(
        F.max("_text").alias("_text"))
    texts = written(texts, "listed-texts")       # of rows repeated with one id, one
    # Only lists with two members matter.  Counts are pre-aggregated and joined back, so a
    # list as long as a large group of copies is split like any skewed join.
    lists = written(listed_items(texts, common).select(*LIST), "listed")
    lists = written(_of_items(lists, lists.groupBy("_item").agg(
        F.count(F.lit(1)).alias("_k")).where("_k > 1")), "lists")
    now = lists.withColumn("_label", F.col("_id"))
    links, tried, left = None, None, _pairs_left(now)
    for _ in range(MAX_ROUNDS):
        if left == 0:
            break
        stars = _stars(now, first=links is None)
        if tried is not None:
            stars = stars.join(tried, ["a", "b"], "left_anti")
        stars = written(stars, "stars")
        tried = stars if tried is None else written(tried.unionByName(stars), "tried")
        found = verified(stars, texts)
        links = written(found if links is None else links.unionByName(found), "links")
        now = written(_open_lists(lists, components(links)), "open-lists")
        before, left = left, _pairs_left(now)
        if left > 0.75 * before:
            break
    if links is None or left == 0:
        return links if links is not None else stars_of_none(rows)
    # What is left: members of one list in different components.
    u, v = (now.select(*[F.col(c).alias(f"{p}{c}") for c in now.columns]) for p in "uv")
    rest = u.join(v, F.expr("u_item = v_item AND u_id < v_id AND u_label <> v_label AND "
                            + may_link("u", "v"))).select(
        F.col("u_id").alias("a"), F.col("v_id").alias("b")).distinct()
    for a, b in (("a", "b"), ("b", "a")):
        rest = rest.join(tried.select(F.col(a).alias("a"), F.col(b).alias("b")), ["a", "b"],
                         "left_anti")
    return links.unionByName(verified(rest, texts))


def stars_of_none(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("_id").alias("a"), F.col("_id").alias("b")).limit(0)


def _of_items(lists: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of the lists of ``items``.  What is joined to lists is written first: a join of
    plain shuffles is split where a list is long, one with an aggregate inside is not."""
    items = written(items.select("_item"), "items")
    return lists.join(items, "_item", "left_semi").select(*lists.columns)


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the lists that still hold more than one component, with their label."""
    l, c = lists.alias("l"), labels.alias("c")
    known = written(l.join(c, F.expr("l._id = c.node"), "left").select(
        *[F.col(f"l.{x}").alias(x) for x in LIST], F.coalesce("c.label", "l._id").alias("_label")),
        "labelled-lists")
    return _of_items(known, known.groupBy("_item").agg(
        F.min("_label").alias("_lo"), F.max("_label").alias("_hi")).where("_lo < _hi"))


def _pairs_left(lists: DataFrame) -> int:
    """Pairs of list members in different components (over all lists)."""
    per = lists.groupBy("_item", "_label").agg(F.count(F.lit(1)).alias("k"))
    per = per.groupBy("_item").agg(F.sum("k").alias("s"), F.sum(F.col("k") * F.col("k")).alias("q"))
    return int(per.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0] or 0)


def _stars(lists: DataFrame, first: bool) -> DataFrame:
    """Per list, the pivot with every member of another component that may link to it."""
    pool = lists
    if not first:
        # The pivot of a later round is outside the list's largest component.
        size = lists.groupBy("_item", "_label").agg(F.count(F.lit(1)).alias("_k"))
        main = written(size.groupBy("_item").agg(F.max(F.struct("_k", "_label")).alias("_m")),
                       "main-components")
        pool = lists.join(main, "_item").where("_label <> _m._label")
    pick = F.struct("_common", (-F.col("_n")).alias("_minus"), "_id", "_n", "_most", "_at",
                    "_label")
    pivot = pool.groupBy("_item").agg(F.max(pick).alias("_p")).select(
        "_item", *[F.col(f"_p.{c}").alias(f"p{c}") for c in ("_id", "_n", "_most", "_at",
                                                             "_label")])
    pivot = written(pivot, "pivots")
    return (lists.join(pivot, "_item").where(f"_label <> p_label AND {may_link('', 'p')}")
            .select(F.col("p_id").alias("a"), F.col("_id").alias("b")).distinct())


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable by links) per row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    sets = written(set_digests(rows), "set-digests")
    own = sets.select("_id", "_n", "_d1", "_d2")
    classes = own.where("_n > 0 AND _id IS NOT NULL").groupBy("_d1", "_d2", "_n").agg(
        F.min("_id").alias("_rep"))
    histogram = {r["_n"]: r["k"] for r in classes.groupBy(
        F.least("_n", F.lit(4 * MAX_SMALL)).alias("_n")).agg(F.count(F.lit(1)).alias("k"))
        .collect()}                                        # at most 4 * MAX_SMALL rows
    x = boundary(histogram)
    member = written(own.where("_id IS NOT NULL").join(classes, ["_d1", "_d2", "_n"])
                     .select("_id", "_rep"), "members")
    links = member.where("_id <> _rep").select(F.col("_id").alias("a"), F.col("_rep").alias("b"))
    if x:
        reps = classes.join(sets.where("_items IS NOT NULL").groupBy("_d1", "_d2").agg(
            F.max("_items").alias("_items")), ["_d1", "_d2"])
        links = links.unionByName(small_links(
            reps.select(F.col("_rep").alias("_id"), "_n", "_items"), x))
    links = links.unionByName(large_links(rows.where("_id IS NOT NULL"), own, classes,
                                          listed_from(x)))
    labels = components(links)
    o, c = own.alias("o"), labels.alias("c")
    return o.join(c, F.expr("o._id = c.node"), "left").select(
        F.col("o._id").alias(id_col), F.col("o._n").alias("n_shingles"),
        F.coalesce("c.label", "o._id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per component of rows, all columns as they were.

    Rows link by their texts alone, so rows without an id take part and unlike texts that
    share an id stay apart.  The row with the smallest id stays, null ids last, then that
    with the smallest text hash.  Blank texts link to nothing: of those equal in id (null
    included) and text one stays.
    """
    # Every row gets a number of its own, fixed by writing it.
    rows = written(docs.select(F.struct("*").alias("_row"),
                               F.monotonically_increasing_id().alias("_at")), "rows")
    ident, text = F.col("_row").getField(id_col), F.col("_row").getField(text_col)
    groups = jaccard_join(rows.select("_at", text.alias("_t")), "_at", "_t")
    named = rows.select("_at", ident.alias("_i"), F.xxhash64(text).alias("_h"))
    blank = F.col("n_shingles") == 0
    kept = groups.join(named, "_at").groupBy(
        F.when(~blank, F.col("component_id")).alias("_c"), F.when(blank, F.col("_i")).alias("_b"),
        F.when(blank, F.col("_h")).alias("_bh")).agg(
        F.min(F.struct(F.col("_i").isNull().alias("n"), "_i", "_h", "_at")).alias("_m"))
    return rows.join(kept.select(F.col("_m._at").alias("_at")), "_at", "left_semi").select("_row.*")
