"""Structured Streaming flows of the bronze and silver layers.

Topology (each arrow is one streaming query with its own checkpoint; tables are Parquet
folders, written by file sinks or batch by batch exactly once, so every hand-off is
durable and each stage survives executor loss and restarts):

    landing/<source>  --ingest-->  bronze.<source>
    bronze.transactions --normalise+dedup+rules-->  silver.transactions_validated
    silver.transactions_validated --valid-->        silver.transactions
    silver.transactions_validated --rejects-->      silver.quarantine_transactions
    silver.transactions --KPI partials-->           state of gold.daily_transaction_kpis
    (the same for merchants, but for the KPIs)
    bronze.users --split--> silver.users_validated, silver.users_structure_quarantine
    silver.users_validated --flags--> silver.users, silver.users_quarantine

The quarantine is one query and one directory per entity, so a source can be added
or refreshed on its own (two file-sink queries on one directory would silently lose
rows, and a union of them could not change its sources); ``quarantine_table`` and the
catalog view ``silver.quarantine`` are their union.  The validated tables are
persisted, so the stateful dedup runs once for both consumers.  Dedup state is
unbounded (every key ever seen), as in the source pipeline, unless
``FlowOptions.dedup_within`` bounds it; the session uses the RocksDB state store so it lives off-heap, and the number of state partitions is fixed
by ``spark.sql.shuffle.partitions`` at the first run - size it for the target volume
before the first checkpoint is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from stratum.operators.dedup import hot_keys
from stratum.operators.quality import QUARANTINE_SCHEMA, REASON
from stratum.plans import gold, merchants, transactions, users
from stratum.sources.files import (bronze_rows, file_names, load_schema, read_versioned,
                                   text_stream, write_small_text, write_versioned)
from stratum.sources.registry import SourceSpec
from stratum.sources.tables import (Layout, declare_table, ensure_namespaces, path_exists,
                                    read_path, register, require_schema, stream_path)
from stratum.streaming.publish import append_once, make_folder

QUARANTINE = "silver.quarantine"
ENTITIES = {"transactions": transactions, "merchants": merchants}
USERS_TABLE = "silver.users"
USERS_VALIDATED = "silver.users_validated"
USERS_STRUCT_Q = "silver.users_structure_quarantine"
USERS_RULE_Q = "silver.users_quarantine"


@dataclass
class FlowOptions:
    # None: available-now (process what is there, then stop); else run
    # continuously with this trigger interval, e.g. "1 minute".
    processing_time: str | None = None
    max_files_per_trigger: int | None = None
    # Partitions that hot dedup keys are spread over; None: as many as shuffle
    # partitions, 0: no spreading.  Fixed once checkpointed.
    dedup_salt_buckets: int | None = None
    # Look for hot keys in the bronze files that are new since the last start.
    find_hot_keys: bool = True
    # Bounded dedup state, e.g. "7 days" after the first copy; None: every key for ever.
    # Fixed once checkpointed.
    dedup_within: str | None = None
    dedup_time: str = "_ingestion_timestamp"


def _triggered(df: DataFrame, checkpoint: str, name: str, opts: FlowOptions) -> DataStreamWriter:
    active = {q.name for q in df.sparkSession.streams.active}
    if name in active:  # another pipeline (layout) runs the same flow in this session
        name = f"{name}_{abs(hash(checkpoint)) % 10**8:08d}"
    w = df.writeStream.option("checkpointLocation", checkpoint).queryName(name)
    if opts.processing_time:
        return w.trigger(processingTime=opts.processing_time)
    return w.trigger(availableNow=True)


def _start(df: DataFrame, path: str, checkpoint: str, name: str, opts: FlowOptions,
           partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    w = _triggered(df, checkpoint, name, opts).format("parquet").outputMode("append").option(
        "path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()


def _finish(spark: SparkSession, q: StreamingQuery, opts: FlowOptions) -> StreamingQuery:
    """Available-now: wait for the end.  Continuous: wait until the data present
    at start is processed (so dependents find their input), then keep running."""
    if opts.processing_time:
        q.processAllAvailable()
    else:
        q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def with_contract(spec: SourceSpec) -> SourceSpec:
    """Columns that the silver rules parse themselves stay text, unless declared."""
    plan = ENTITIES.get(spec.source_name)
    if plan is None:
        return spec
    return replace(spec, types={c: "string" for c in plan.RAW_COLUMNS} | spec.types)


def ingest(spark: SparkSession, layout: Layout, spec: SourceSpec,
           opts: FlowOptions | None = None) -> StreamingQuery:
    """Landing folder -> bronze.<source_name> (typed, rescued, with lineage).

    Text has one column for ever and goes straight to the file sink.  Of the other formats
    the stream carries file names; each micro-batch infers, evolves and reads exactly
    its own files (``sources.files``) and is appended once (``publish``).
    """
    opts = opts or FlowOptions()
    spec = with_contract(spec)
    name = f"bronze.{spec.source_name}"
    flow = name.replace(".", "_")
    path, checkpoint = layout.table_path(name), layout.checkpoint(flow)
    if spec.file_format == "text":
        q = _start(text_stream(spark, spec, opts.max_files_per_trigger), path, checkpoint, flow,
                   opts, spec.partition_by)
        return _finish(spark, q, opts)
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} was written by a file sink, whose log hides other files; "
                         f"full_refresh({name!r}) rebuilds it")
    make_folder(spark, path)

    def take(batch: DataFrame, batch_id: int) -> None:
        # The stream's own session: its settings do not reach the caller's.
        rows = bronze_rows(batch.sparkSession, spec, batch.collect(), batch_id)
        if rows is not None:
            append_once(rows, path, f"{checkpoint}/publish", batch_id, spec.partition_by)

    writer = _triggered(file_names(spark, spec, opts.max_files_per_trigger), checkpoint, flow, opts)
    q = _finish(spark, writer.foreachBatch(take).start(), opts)
    if load_schema(spark, spec.schema_location) is None:
        q.stop()
        raise ValueError(f"no files and no persisted schema for source {spec.source_name!r}")
    return q


def _validated_plan(spark: SparkSession, layout: Layout, entity: str, opts: FlowOptions,
                    bronze_schema: T.StructType | None = None,
                    hot: Sequence[int] = ()) -> DataFrame:
    src = stream_path(spark, layout.table_path(f"bronze.{entity}"), bronze_schema)
    return ENTITIES[entity].validate(
        src, batch_order=None, salt_buckets=_salt_buckets(spark, opts), hot=hot,
        within=opts.dedup_within, time_col=opts.dedup_time)


def _salt_buckets(spark: SparkSession, opts: FlowOptions) -> int:
    if opts.dedup_salt_buckets is not None:
        return opts.dedup_salt_buckets
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


HOT_KEPT = 1024  # key hashes remembered, the newest


def known_hot_keys(spark: SparkSession, layout: Layout, entity: str, opts: FlowOptions,
                   bronze_schema: T.StructType | None) -> list[int]:
    """Hot dedup keys: those remembered and those of the bronze files modified since the last
    look.  Only the key column of those files is read.  (What is missed or stale costs
    time, never rows.)"""
    buckets = _salt_buckets(spark, opts)
    if not opts.find_hot_keys or buckets <= 1 or bronze_schema is None:
        return []
    key = ENTITIES[entity].KEY
    if key not in bronze_schema.names:
        return []
    state = f"{layout.checkpoint(f'silver_{entity}_validated')}_hot_keys"
    doc = read_versioned(spark, state) or {"upto": 0, "hashes": []}
    at = F.unix_millis("_metadata.file_modification_time")
    new = spark.read.schema(bronze_schema).parquet(layout.table_path(f"bronze.{entity}")).where(
        at > doc["upto"])
    upto = new.agg(F.max(at)).first()[0]
    if upto is None:
        return doc["hashes"]
    found = hot_keys(new, [key], buckets)
    doc = {"upto": upto, "hashes": list(dict.fromkeys(found + doc["hashes"]))[:HOT_KEPT]}
    write_versioned(spark, state, doc)
    return doc["hashes"]


def validated_plan(spark: SparkSession, layout: Layout, entity: str,
                   opts: FlowOptions | None = None,
                   bronze_schema: T.StructType | None = None) -> DataFrame:
    """The (streaming) validated plan of an entity - for schemas and inspection."""
    return _validated_plan(spark, layout, entity, opts or FlowOptions(), bronze_schema)


def validated_schema(spark: SparkSession, layout: Layout, entity: str,
                     opts: FlowOptions | None = None,
                     bronze_schema: T.StructType | None = None) -> T.StructType:
    """Schema of silver.<entity>_validated, from the plan (no table read)."""
    return _validated_plan(spark, layout, entity, opts or FlowOptions(), bronze_schema).schema


def _validated_source(spark: SparkSession, layout: Layout, entity: str, opts: FlowOptions,
                      bronze_schema: T.StructType | None = None) -> DataFrame:
    """Stream of silver.<entity>_validated with the schema of the validated plan, so
    downstream flows neither scan the table's footers nor wait for it to exist."""
    schema = validated_schema(spark, layout, entity, opts, bronze_schema)
    return stream_path(spark, layout.table_path(f"silver.{entity}_validated"), schema)


def validated(spark: SparkSession, layout: Layout, entity: str,
              opts: FlowOptions | None = None,
              bronze_schema: T.StructType | None = None) -> StreamingQuery:
    """bronze.<entity> -> silver.<entity>_validated (streaming first-seen dedup).

    ``bronze_schema`` (see ``sources.files.bronze_schema``) avoids discovering the
    bronze schema from the footers of all its files."""
    opts = opts or FlowOptions()
    out = _validated_plan(spark, layout, entity, opts, bronze_schema,
                          known_hot_keys(spark, layout, entity, opts, bronze_schema))
    # Per-micro-batch quality metrics, reported in the query progress
    # (``q.lastProgress["observedMetrics"]``) at no extra pass over the data.
    out = out.observe(f"silver_{entity}_validated",
                      F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col(REASON).isNotNull()).alias("rejected"))
    q = _start(out, layout.table_path(f"silver.{entity}_validated"),
               layout.checkpoint(f"silver_{entity}_validated"), f"silver_{entity}_validated", opts)
    return _finish(spark, q, opts)


def clean(spark: SparkSession, layout: Layout, entity: str,
          opts: FlowOptions | None = None,
          bronze_schema: T.StructType | None = None) -> StreamingQuery:
    opts = opts or FlowOptions()
    plan = ENTITIES[entity]
    src = _validated_source(spark, layout, entity, opts, bronze_schema)
    q = _start(plan.clean(src), layout.table_path(f"silver.{entity}"),
               layout.checkpoint(f"silver_{entity}"), f"silver_{entity}", opts)
    return _finish(spark, q, opts)


def quarantine_name(entity: str) -> str:
    return f"{QUARANTINE}_{entity}"


def quarantine(spark: SparkSession, layout: Layout, entity: str,
               opts: FlowOptions | None = None, declare: bool = True,
               bronze_schema: T.StructType | None = None) -> StreamingQuery:
    """Reject rows of one validated table into its part of the quarantine.

    ``declare`` creates the catalog table with its declared schema first, and makes
    ``silver.quarantine`` the union of the entities declared so far.
    """
    opts = opts or FlowOptions()
    name = quarantine_name(entity)
    if declare:
        ensure_namespaces(spark, ["silver"])
        declare_table(spark, layout, name, QUARANTINE_SCHEMA,
                      comment=f"Rejected records of the {entity} rules",
                      properties={"quality": "silver"})
        parts = [quarantine_name(e) for e in ENTITIES
                 if spark.catalog.tableExists(quarantine_name(e))]
        spark.sql(f"CREATE OR REPLACE VIEW {QUARANTINE} AS "
                  + " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts))
    rejects = ENTITIES[entity].quarantine(
        _validated_source(spark, layout, entity, opts, bronze_schema))
    require_schema(name, QUARANTINE_SCHEMA, rejects.schema)
    q = _start(rejects, layout.table_path(name),
               layout.checkpoint(name.replace(".", "_")), name.replace(".", "_"), opts)
    return _finish(spark, q, opts)


def quarantine_table(spark: SparkSession, layout: Layout) -> DataFrame:
    """The reject rows of every entity, by the commit log of each part."""
    parts = [spark.read.schema(QUARANTINE_SCHEMA).parquet(path) for e in ENTITIES
             if path_exists(spark, path := layout.table_path(quarantine_name(e)))]
    if not parts:
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union


def users_plans(spark: SparkSession, layout: Layout, bronze_schema: T.StructType | None,
                source: str = "users") -> dict[str, Callable[[], DataFrame]]:
    """The (streaming) plans of the users tables, in order; each is made when its turn
    comes, since the last two read the first one's files."""
    def split() -> tuple[DataFrame, DataFrame]:
        raw = stream_path(spark, layout.table_path(f"bronze.{source}"), bronze_schema)
        return users.split_lines(raw, keep=("_source_file",))

    def flagged() -> DataFrame:
        return users.flags(users.normalize(split()[0]))

    def stored() -> DataFrame:
        return stream_path(spark, layout.table_path(USERS_VALIDATED), flagged().schema)

    return {USERS_VALIDATED: flagged, USERS_STRUCT_Q: lambda: split()[1],
            USERS_TABLE: lambda: users.clean_and_quarantine(stored())[0],
            USERS_RULE_Q: lambda: users.clean_and_quarantine(stored())[1]}


def users_flow(spark: SparkSession, layout: Layout, table: str, plan: DataFrame,
               opts: FlowOptions | None = None) -> StreamingQuery:
    opts = opts or FlowOptions()
    flow = table.replace(".", "_")
    q = _start(plan, layout.table_path(table), layout.checkpoint(flow), flow, opts)
    return _finish(spark, q, opts)


def kpi_partials(spark: SparkSession, layout: Layout, clean_schema: T.StructType,
                 folder: str, checkpoint: str) -> StreamingQuery:
    """silver.transactions -> one folder of additive KPI partials per micro-batch.

    A batch that is run again after a crash has the same rows (its offsets are
    logged first) and replaces its own folder, unless that was marked whole, so no
    delivery counts twice.  The mark is our own: stores may do without success files.
    Folders are partitioned by date.  Always available-now: each refresh takes what has
    arrived.
    """
    src = spark.readStream.schema(clean_schema).parquet(layout.table_path("silver.transactions"))

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = f"{folder}/_whole/batch-{batch_id:09d}"
        if path_exists(spark, mark):
            return
        (gold.kpi_partials(batch).hint("rebalance", "transaction_date")
         .write.mode("overwrite").partitionBy("transaction_date")
         .parquet(f"{folder}/run=batch-{batch_id:09d}"))
        write_small_text(spark, mark, "")

    q = (src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def bronze_table(spark: SparkSession, layout: Layout, source: str) -> DataFrame:
    return read_path(spark, layout.table_path(f"bronze.{source}"))


def register_silver(spark: SparkSession, layout: Layout, entity: str,
                    validated: T.StructType) -> None:
    register(spark, layout, f"silver.{entity}_validated", validated,
             comment=f"Validated {entity} (all deduplicated rows + rejection_reason)",
             properties={"pipelines.reset.allowed": "true"})
    register(spark, layout, f"silver.{entity}",
             T.StructType([f for f in validated.fields if f.name != REASON]),
             comment=f"Clean {entity}", properties={"quality": "silver"})
