"""WARC: deterministic sharded writer and reader.

Records are range-sorted by (id, digest), each shard is written by one task as a
series of files that roll at a compressed size, and a write becomes visible through
a manifest:

1. every task attempt writes its files under a temporary name of its own (part,
   attempt and a random suffix), so retries and speculative copies never meet;
2. the rows a task returns (temporary name, final name, records, bytes, SHA-256) go
   through Spark's own output committer, which keeps one attempt's rows only;
3. a second pass renames what the committed rows name (idempotent: a file that
   already has its final name is left), and the manifest is published by renaming
   its folder.  A reader trusts the manifest alone, so a crash leaves ignorable
   temporary files and never half a collection.

Shards come from exact sums of payload bytes over equal parts of the id range, then of
the digests of one id (rows without an id are such a one); all parts that are too heavy are
refined by one aggregate per level.  The driver sees a few numbers per shard; rows find
their shard by broadcast joins of those.  Rows equal in id and payload that fill several
shards are counted and dealt to them (``_spread``).  Records sort within a shard by
(id, digest, url); so shards, files and bytes are the same on every run.

Duplicate payloads: of equal payloads of at least ``min_payload`` bytes the record
with the smallest id (of several, the first in order) is the response, the others are
revisits with an empty block that name its record id, length and digest.  Only (digest, min id) of payloads that
occur twice is shuffled for this, pre-aggregated per task; payloads move once.

Defined results: null payload = empty; null url = empty target; null id is never
chosen while another copy has an id, and sorts last; of rows tied on the smallest id, or
all without one, that with the least url (null first) is the response; an empty table
writes a manifest of no files; other columns are not read.
"""

from __future__ import annotations

import decimal
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HIST = 4096          # parts of a range at most
RUN = 4096           # equal records written out together
MANIFEST_SCHEMA = ("shard int, seq int, tmp string, name string, records long, "
                   "bytes long, sha256 string")
RECORD_SCHEMA = ("page_id long, target_uri string, payload_bytes long, payload_digest string, "
                 "record_type string, refers_to long, block_bytes long, archive string")
NULL_ID = "null"


def open_fs(uri: str):
    """(filesystem, path) for a task: any store pyarrow knows; s3a is s3."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[6:]
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


# ---- record format ---------------------------------------------------------------

def record_id(page_id: int | None, digest: str) -> str:
    """Derived from the content, so that headers are regenerated identically."""
    name = f"{NULL_ID if page_id is None else page_id}:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record_bytes(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to,
                 date: str) -> bytes:
    """One uncompressed WARC/1.1 record; a revisit may refer to a response without an id."""
    block = b"" if revisit else payload
    uri = " ".join((url or "").split())
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Page-Id: {NULL_ID if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page-Id: {NULL_ID if refers_to is None else refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member without a time stamp: equal input, equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The records of a .warc.gz stream, one gzip member at a time."""
    d, out, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(step)
        rest = b""
        if not data:
            if any(out):
                raise ValueError("truncated gzip member")
            return
        out.append(d.decompress(data))
        if d.eof:
            yield b"".join(out)
            rest, out, d = d.unused_data, [], zlib.decompressobj(31)


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(h["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("record length does not match its block")
    if h["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError("block digest does not match")
    return {"h": h, "block": block}


# ---- writer ----------------------------------------------------------------------

# A place in the order (id, digest) as cells: a level cuts ranges of ids or of digests into
# equal parts; parts that are too heavy are ranges of the next level.
ID, DIGEST = 0, 1
DIGEST_BITS = 60        # the first 15 hex digits tell digests apart
PLACE = "CASE WHEN _kind_of = 0 THEN cast(_id AS decimal(20,0)) ELSE cast(_prefix AS decimal(20,0)) END"


@dataclass
class Range:
    node: int
    kind: int           # of ids or of digests
    start: int
    width: int
    step: int           # width of a part
    path: tuple         # its place in the order
    children: dict      # part -> ("leaf", number) or ("node", number)


@dataclass
class Cells:
    """Levels of ranges, and per leaf its shard and in how many it is split."""
    levels: list
    shard: dict
    split: dict
    n_shards: int


def _range(node: int, kind: int, start: int, width: int, parts: int, path: tuple) -> Range:
    return Range(node, kind, start, width, max(1, -(-width // max(1, min(parts, HIST)))), path, {})


def _with_node(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "_prefix": F.conv(F.substring("_digest", 1, DIGEST_BITS // 4), 16, 10).cast("long"),
        "_node": F.col("_id").isNull().cast("int")})


def _part(df: DataFrame, level: list) -> DataFrame:
    """The rows in a level's ranges, with their ``_part``."""
    table = df.sparkSession.createDataFrame(
        [(r.node, r.kind, decimal.Decimal(r.start), decimal.Decimal(r.step)) for r in level],
        "_at_node int, _kind_of int, _start decimal(20,0), _step decimal(20,0)")
    return df.join(F.broadcast(table), F.col("_node") == F.col("_at_node")).withColumn(
        "_part", F.expr(f"cast(({PLACE} - _start) div _step AS int)")).drop(
        "_at_node", "_kind_of", "_start", "_step")


def _next(df: DataFrame, level: list) -> DataFrame:
    """Rows of a level with the ``_leaf`` or the ``_node`` that their part is."""
    rows = [(r.node, part, n if kind == "leaf" else None, n if kind == "node" else None)
            for r in level for part, (kind, n) in r.children.items()]
    table = df.sparkSession.createDataFrame(
        rows, "_at_node int, _at_part int, _leaf_of int, _node_of int")
    found = _part(df, level).join(F.broadcast(table), (F.col("_node") == F.col("_at_node"))
                                  & (F.col("_part") == F.col("_at_part")))
    return found.withColumns({"_leaf": F.coalesce("_leaf", "_leaf_of"), "_node": F.col("_node_of")}
                             ).drop("_at_node", "_at_part", "_leaf_of", "_node_of", "_part")


def cells_of(facts: DataFrame, shard_bytes: int) -> Cells:
    """Cut the order (id, digest) into shards of about ``shard_bytes`` by exact sums.

    One aggregate per level refines all heavy parts at once; a level has at most
    ``HIST`` parts for each, and no more than a few for each shard that they fill.  A range
    runs from the least to the greatest place in its rows, so one hot id among far ones is
    cut by digests in the next level.  What is left heavy is one id with one digest: a leaf
    split into several shards.
    """
    lo, hi = facts.agg(F.min("_id"), F.max("_id")).first()
    level = [_range(1, DIGEST, 0, 1 << DIGEST_BITS, HIST, (1,))]
    if lo is not None:
        level.insert(0, _range(0, ID, lo, hi - lo + 1, HIST, (0,)))
    levels, leaves, nodes = [], [], 2
    rows = _with_node(facts).withColumn("_leaf", F.lit(None).cast("int"))
    while level:
        by_node = {r.node: r for r in level}
        deeper = []
        sums = _part(rows, level).groupBy("_node", "_part").agg(
            F.sum("_size").alias("b"), F.min("_id").alias("lo_id"), F.max("_id").alias("hi_id"),
            F.min("_prefix").alias("lo_digest"), F.max("_prefix").alias("hi_digest"))
        for g in sums.orderBy("_node", "_part").collect():
            r = by_node[g._node]
            kind = ID if g.lo_id != g.hi_id else DIGEST
            lo, hi = (g.lo_id, g.hi_id) if kind == ID else (g.lo_digest, g.hi_digest)
            path = (*r.path, g._part)
            parts = -(-2 * g.b // shard_bytes)
            if g.b > shard_bytes and lo < hi:
                r.children[g._part] = ("node", nodes)
                deeper.append(_range(nodes, kind, lo, hi - lo + 1, parts, path))
                nodes += 1
            else:
                r.children[g._part] = ("leaf", len(leaves))
                leaves.append((path, g.b))
        levels.append(level)
        if deeper:
            rows = _next(rows, level).where("_node IS NOT NULL")
        level = deeper
    shard, split, no, run = {}, {}, 0, 0
    for leaf in sorted(range(len(leaves)), key=lambda i: leaves[i][0]):
        size = leaves[leaf][1]
        if run and run + size > shard_bytes:
            no, run = no + 1, 0
        shard[leaf], split[leaf] = no, max(1, size // shard_bytes)
        if split[leaf] > 1:
            no, size = no + split[leaf] - 1, 0
        run += size
    return Cells(levels, shard, split, no + 1 if leaves else 1)


def _placed(rows: DataFrame, cells: Cells) -> DataFrame:
    """``rows`` (_id, _digest, ...) with ``_shard`` and ``_split``; one broadcast join of a
    few numbers per shard for each level."""
    out = _with_node(rows).withColumn("_leaf", F.lit(None).cast("int"))
    done = None
    for level in cells.levels:
        out = _next(out, level)
        ready = out.where("_leaf IS NOT NULL")
        done = ready if done is None else done.unionByName(ready)
        out = out.where("_leaf IS NULL")
    table = rows.sparkSession.createDataFrame(
        [(i, cells.shard[i], cells.split[i]) for i in cells.shard],
        "_at_leaf int, _shard int, _split int")
    return done.join(F.broadcast(table), F.col("_leaf") == F.col("_at_leaf")).drop(
        "_at_leaf", "_leaf", "_node", "_prefix")


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of a leaf that fills several shards, dealt to them.

    They are equal in id and payload, so those with one URL are counted (pre-aggregated),
    cut into runs, and written out again behind the cut.  The first run of the least URL
    stays in the first shard.
    """
    group = ["_id", "_digest", "_shard", "_split", "_url"]
    counted = rows.groupBy(*group).agg(F.any_value("_payload").alias("_payload"),
                                       F.count(F.lit(1)).alias("_n"))
    least = counted.groupBy("_id", "_digest").agg(F.min(F.struct("_url")).alias("_least")).select(
        F.col("_id").alias("_li"), F.col("_digest").alias("_ld"), "_least")
    runs = counted.select("*", F.explode(F.expr(f"sequence(0L, (_n - 1) div {RUN})")).alias("_run"))
    runs = runs.join(least, F.expr("_li <=> _id AND _ld = _digest"))
    first = (F.col("_run") == 0) & F.col("_url").eqNullSafe(F.col("_least._url"))
    runs = runs.withColumn("_shard", (F.col("_shard") + F.when(first, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("_url", "_run"), F.col("_split")))).cast("int"))
    return runs.select("_id", "_digest", "_url", "_payload", "_shard", F.explode(F.expr(
        f"sequence(1L, least({RUN}L, _n - _run * {RUN}L))")).alias("_copy")).drop("_copy")


def write_warc(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_payload: int = 100, shard_bytes: int = 32 << 20,
               file_bytes: int = 16 << 20, date: str = "2024-01-01T00:00:00Z",
               level: int = 6) -> DataFrame:
    """Write ``pages`` under ``root``; returns the committed manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                        F.col(f"`{url_col}`").cast("string").alias("_url"),
                        payload.alias("_payload"))
    facts = rows.select("_id", F.octet_length("_payload").cast("long").alias("_size"),
                        F.sha2("_payload", 256).alias("_digest"))
    copies = (facts.where(F.col("_size") >= min_payload).groupBy("_digest")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
              .where("_n > 1"))
    # Which rows refer where: narrow rows only, so the payloads are not shuffled for it.
    # Of the rows tied on the smallest id (or all without one), the first in order leads.
    refers = (facts.where(F.col("_size") >= min_payload).groupBy("_id", "_digest").agg(
        F.lit(1).alias("_one")).join(copies, "_digest").select("_id", "_digest", "_first"))
    cells = cells_of(facts, shard_bytes)
    n = cells.n_shards
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("long")
    placed = _placed(rows.withColumn("_digest", F.sha2("_payload", 256)), cells)
    page = lambda df: df.select("_id", "_digest", F.lit(1).alias("_kind"), "_url", "_payload",
                                none_l.alias("_first"), "_shard", F.lit(False).alias("_lead"))
    dealt = page(placed.where("_split = 1")) if max(cells.split.values(), default=1) > 1 else page(placed)
    if max(cells.split.values(), default=1) > 1:
        dealt = dealt.unionByName(page(_spread(placed.where("_split > 1"))))
    # A decision goes to every shard of its leaf; only the first one may hold a leader.
    told = _placed(refers, cells).withColumn("_nth", F.explode(F.expr("sequence(0, _split - 1)")))
    dealt = dealt.unionByName(told.select(
        "_id", "_digest", F.lit(0).alias("_kind"), none_s.alias("_url"), none_s.alias("_payload"),
        "_first", (F.col("_shard") + F.col("_nth")).cast("int").alias("_shard"),
        (F.col("_id").eqNullSafe(F.col("_first")) & (F.col("_nth") == 0)).alias("_lead")))
    # A shard stays in one partition; the sort puts each decision before its pages.
    dealt = dealt.repartitionByRange(n, "_shard").sortWithinPartitions(
        "_shard", F.col("_id").asc_nulls_last(), "_digest", "_kind", "_url")
    attempt_root = f"{root}/_tmp"

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(attempt_root)
        fs.create_dir(base, recursive=True)
        ctx = TaskContext.get()
        tag = f"{ctx.partitionId() if ctx else 0}-{ctx.taskAttemptId() if ctx else 0}-" \
              f"{uuid.uuid4().hex[:8]}"
        state = {"out": None}
        done: list[tuple] = []
        counters: dict[int, int] = {}

        def close():
            if state["out"] is not None:
                state["out"].close()
                done.append((state["shard"], state["seq"], state["tmp"],
                             f"warc-{state['shard']:06d}-{state['seq']:05d}.warc.gz",
                             state["records"], state["bytes"], state["sha"].hexdigest()))
                state["out"] = None

        def open_new(shard_no):
            close()
            seq = counters.get(shard_no, 0)
            counters[shard_no] = seq + 1
            tmp = f"{tag}-{shard_no}-{seq}.part"
            state.update(shard=shard_no, seq=seq, tmp=tmp, records=0, bytes=0,
                         sha=hashlib.sha256(), out=fs.open_output_stream(f"{base}/{tmp}"))

        decided = None          # (id, digest, what it refers to, whether a leader is due)
        for b in batches:
            cols = {k: b.column(k) for k in b.schema.names}
            for i in range(b.num_rows):
                pid, dig = cols["_id"][i].as_py(), cols["_digest"][i].as_py()
                no = cols["_shard"][i].as_py()
                if cols["_kind"][i].as_py() == 0:
                    decided = [pid, dig, cols["_first"][i].as_py(), cols["_lead"][i].as_py()]
                    continue
                revisit = decided is not None and decided[:2] == [pid, dig] and not decided[3]
                first = decided[2] if revisit else None
                if decided is not None:
                    decided[3] = False
                data = gzip_member(record_bytes(
                    pid, cols["_url"][i].as_py(), cols["_payload"][i].as_py().encode("utf-8"),
                    dig, revisit, first, date), level)
                if state["out"] is None or state["shard"] != no or (
                        state["records"] and state["bytes"] + len(data) > file_bytes):
                    open_new(no)
                state["out"].write(data)
                state["sha"].update(data)
                state["records"] += 1
                state["bytes"] += len(data)
        close()
        names = ["shard", "seq", "tmp", "name", "records", "bytes", "sha256"]
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(),
                 pa.string()]
        cols = list(zip(*done)) if done else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                         names)

    pending = f"{root}/_manifest.pending"
    dealt.mapInArrow(write_part, MANIFEST_SCHEMA).write.parquet(pending)

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs
        fs, base = open_fs(root)
        for b in batches:
            for r in b.select(["tmp", "name"]).to_pylist():
                src, dst = f"{base}/_tmp/{r['tmp']}", f"{base}/{r['name']}"
                if fs.get_file_info(src).type != pafs.FileType.NotFound:
                    fs.move(src, dst)
                elif fs.get_file_info(dst).type == pafs.FileType.NotFound:
                    raise FileNotFoundError(dst)
            yield b

    committed = spark.read.schema(MANIFEST_SCHEMA).parquet(pending)
    committed.mapInArrow(publish, MANIFEST_SCHEMA).write.parquet(f"{root}/_manifest.new")
    _rename(spark, f"{root}/_manifest.new", f"{root}/_manifest")
    return read_manifest(spark, root)


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(path(src), path(dst)):
        raise OSError(f"cannot publish {dst}")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/_manifest")


# ---- reader ----------------------------------------------------------------------

def read_warc(spark: SparkSession, root: str) -> DataFrame:
    """The records of every file the manifest names, verified while streaming.

    Files are dealt to tasks by name; a task holds one record at a time.
    """
    manifest = read_manifest(spark, root)
    files = manifest.count()
    spread = manifest.repartition(max(1, files), "name") if files else manifest

    def read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(root)
        names = ["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type",
                 "refers_to", "block_bytes", "archive"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                 pa.int64(), pa.string()]

        def batch(rows):
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, types)], names)

        for b in batches:
            for m in b.to_pylist():
                rows, n = [], 0
                with fs.open_input_stream(posixpath.join(base, m["name"]),
                                          compression=None) as f:
                    for raw in members(f):
                        r = parse_record(raw)
                        h, block = r["h"], r["block"]
                        kind = h["WARC-Type"]
                        digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                            raise ValueError("payload digest does not match")
                        pid, ref = h["X-Page-Id"], h.get("X-Refers-To-Page-Id")
                        rows.append((None if pid == NULL_ID else int(pid), h["WARC-Target-URI"],
                                     int(h["X-Payload-Length"]), digest, kind,
                                     None if ref in (None, NULL_ID) else int(ref), len(block),
                                     m["name"]))
                        n += 1
                        if len(rows) >= 2000:
                            yield batch(rows)
                            rows = []
                if n != m["records"]:
                    raise ValueError(f"{m['name']}: {n} records, manifest has {m['records']}")
                yield batch(rows)

    return spread.mapInArrow(read_part, RECORD_SCHEMA)
