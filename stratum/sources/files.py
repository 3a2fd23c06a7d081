"""Incremental file sources with typed inference, schema persistence,
additive schema evolution, rescued values and file lineage.

How a micro-batch works (``streaming.flows.ingest``): a stream of file *names* gives every
micro-batch the files that arrived, whatever their modification times and whenever they
landed; a batch holds at most ``MAX_FILES`` of them (the one list that reaches the
driver).  Then, for exactly these files:
  1. infer a typed schema.  JSON: Spark's inference.  CSV: the header of each file, and
     one aggregate that types the columns not known yet; with none, no pass at all.  So a
     file is read at most twice.  Dates, timestamps and numbers with leading zeros stay
     text, because one delivery's formats say nothing about the next one's, and declared
     types win over inference;
  2. merge it into the schema persisted at ``schema_location``: known columns
     keep their first type, new columns are appended (or, with ``evolution: rescue``,
     kept in ``_rescued_data``).  Schemas are numbered files, the newest complete one
     counts, so a crash leaves the old one or the new one;
  3. read the files with every column as raw text (JSON numbers, booleans and nested
     values as VARIANT), CSV by name: files with one header are one read, in the order
     of that header.  Then cast each column to its persisted type.  A value present in
     the file that does not fit its type becomes NULL and is kept, as text, in
     ``_rescued_data`` (a JSON object column -> raw value), as are keys that differ from
     a column in case only, surplus CSV values and the text of an unparseable JSON
     document, instead of failing the batch or being lost;
  4. add ``_ingestion_timestamp`` and ``_source_file`` (``_metadata.file_name``).
A batch that is run again after a crash has the same files, so it merges and reads the
same.
"""

from __future__ import annotations

import csv
import json
import os
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sources.registry import SourceSpec

RESCUED = "_rescued_data"
INGESTED_AT = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"
META_COLUMNS = (RESCUED, INGESTED_AT, SOURCE_FILE)
CORRUPT = "_stratum_corrupt"  # raw text of a record that the reader could not take whole

_ATOMIC = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
           T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType,
           T.TimestampNTZType)


def reader_options(spec: SourceSpec) -> dict:
    fmt = spec.file_format
    opts: dict = {}
    if fmt == "json":
        opts["multiLine"] = str(spec.options.get("multiline", True)).lower()
    elif fmt == "csv":
        opts["header"] = str(spec.options.get("header", True)).lower()
        if "delimiter" in spec.options:
            opts["sep"] = spec.options["delimiter"]
    return opts


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_small_text(spark: SparkSession, path: str) -> str | None:
    """A small control file (schema, pointer) read on the driver; None if absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small control file under a new name: a sibling first, then a rename,
    so a reader sees the whole file or none."""
    fs, p = _fs(spark, path)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, p):
        raise OSError(f"cannot publish {path}")


VERSIONS_KEPT = 3


def _versions(spark: SparkSession, folder: str) -> list[int]:
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"v(\d+)\.json", n)))


def read_versioned(spark: SparkSession, folder: str) -> dict | None:
    """The newest complete document of a folder of numbered versions."""
    for n in reversed(_versions(spark, folder)):
        text = read_small_text(spark, os.path.join(folder, f"v{n:09d}.json"))
        try:
            return json.loads(text or "")
        except ValueError:  # not complete: an older one counts
            continue
    return None


def write_versioned(spark: SparkSession, folder: str, doc: dict) -> None:
    """Publish ``doc`` as the next version; the last few stay."""
    have = _versions(spark, folder)
    n = have[-1] + 1 if have else 1
    write_small_text(spark, os.path.join(folder, f"v{n:09d}.json"), json.dumps(doc))
    for old in have[:-(VERSIONS_KEPT - 1)]:
        fs, p = _fs(spark, os.path.join(folder, f"v{old:09d}.json"))
        fs.delete(p, False)


def _not_found(exc: Exception) -> bool:
    msg = str(exc)
    return "PATH_NOT_FOUND" in msg or "UNABLE_TO_INFER_SCHEMA" in msg


MAX_FILES = 1000                 # files of one micro-batch, unless the flow says otherwise
MAX_DOCUMENT = 512 * 1024 * 1024  # bytes of one multi-line JSON file: one task parses it whole
ANY_AGE = "36500d"                # files are told apart by name, never by age


def file_names(spark: SparkSession, spec: SourceSpec, max_files: int | None = None) -> DataFrame:
    """Stream of the files that arrive (``path``, ``length``); no content is read."""
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("maxFilesPerTrigger", max_files or MAX_FILES).option("maxFileAge", ANY_AGE)
            .load(spec.source_path).select("path", "length"))


def check_sizes(spec: SourceSpec, files: list) -> None:
    """A JSON array is one task and one buffer: refuse one beyond the bound by name."""
    if spec.file_format != "json" or reader_options(spec)["multiLine"] != "true":
        return
    bound = int(spec.options.get("max_document_bytes", MAX_DOCUMENT))
    large = [f.path for f in files if f.length > bound]
    if large:
        raise ValueError(f"{len(large)} multi-line JSON files are larger than {bound} bytes, e.g. "
                         f"{large[0]}. Write smaller arrays, or JSON Lines with multiline=false, "
                         "or raise max_document_bytes.")


def _literal(path: str) -> str:
    """A path for readers, which take some characters for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _reader(spark: SparkSession, spec: SourceSpec):
    reader = spark.read.options(**reader_options(spec))
    if not re.search(r"[{}\[\]*?]", spec.source_path):
        reader = reader.option("basePath", spec.source_path)
    return reader


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file that is not blank; only its first block is read."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        source = stream if codec is None else codec.createInputStream(stream)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return (line or "").lstrip("\ufeff")
    finally:
        stream.close()


def header_names(line: str, sep: str, header: bool = True) -> tuple[str, ...]:
    """Column names of a header line: blank ones by position, repeated ones numbered."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line], delimiter=sep), [])):
        name = name.strip() if header else ""
        name = name or f"_c{i}"
        while name.lower() in {n.lower() for n in names}:
            name = f"{name}{i}"
        names.append(name)
    return tuple(names)


def csv_groups(spark: SparkSession, spec: SourceSpec, paths: list[str]) -> dict[tuple, list[str]]:
    """Column names -> the files with that header (of one micro-batch); empty files go."""
    sep, header = spec.options.get("delimiter", ","), reader_options(spec)["header"] == "true"
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda p: _first_line(spark, p), paths))
    groups: dict[tuple, list[str]] = {}
    for path, line in zip(paths, lines):
        if line:
            groups.setdefault(header_names(line, sep, header), []).append(path)
    return groups


def _csv_text(spark: SparkSession, spec: SourceSpec, names: tuple, paths: list[str]) -> DataFrame:
    """The files with one header: their columns as text, in that order, and ``CORRUPT``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    return (_reader(spark, spec).option("columnNameOfCorruptRecord", CORRUPT).schema(schema)
            .csv([_literal(p) for p in paths]))


WHOLE, NUMBER = r"^-?(0|[1-9][0-9]*)$", r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def _csv_schema(spark: SparkSession, spec: SourceSpec, groups: dict[tuple, list[str]],
                persisted: T.StructType | None) -> T.StructType:
    """Columns of the headers; those not known yet are typed by one aggregate."""
    known = {f.name.lower() for f in persisted.fields} if persisted else set()
    declared = {k.lower() for k in spec.types}
    names: dict[str, str] = {}
    for header in groups:
        for n in header:
            names.setdefault(n.lower(), n)
    new = [n for k, n in names.items() if k not in known | declared]
    kinds: dict[str, T.DataType] = {}
    if new:
        parts = []
        for header, paths in groups.items():
            have = {n.lower(): n for n in header}
            parts.append(_csv_text(spark, spec, header, paths).select(*[
                F.col(f"`{have[n.lower()]}`").alias(f"c{i}") if n.lower() in have
                else F.lit(None).cast("string").alias(f"c{i}") for i, n in enumerate(new)]))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        stats = []
        for i in range(len(new)):
            v = F.col(f"c{i}")
            whole = F.when(v.rlike(WHOLE), v.try_cast("bigint"))
            stats += [F.count(v).alias(f"n{i}"), F.count(whole).alias(f"w{i}"),
                      F.max(F.abs(whole.cast("decimal(20,0)"))).alias(f"m{i}"),
                      F.count_if(v.rlike(NUMBER)).alias(f"d{i}"),
                      F.count_if(F.lower(v).isin("true", "false")).alias(f"b{i}")]
        got = rows.agg(*stats).first()
        for i, n in enumerate(new):
            seen = got[f"n{i}"]
            if seen and got[f"w{i}"] == seen:
                kinds[n] = T.IntegerType() if got[f"m{i}"] < 1 << 31 else T.LongType()
            elif seen and got[f"d{i}"] == seen:
                kinds[n] = T.DoubleType()
            elif seen and got[f"b{i}"] == seen:
                kinds[n] = T.BooleanType()
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names.values()])


def _declared(spec: SourceSpec, schema: T.StructType) -> T.StructType:
    """Declared types win; inferred dates and timestamps stay text."""
    by_name = {k.lower(): v for k, v in spec.types.items()}

    def kind(f: T.StructField) -> T.DataType:
        if f.name.lower() in by_name:
            return T._parse_datatype_string(by_name[f.name.lower()])
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return T.StringType()
        return f.dataType

    return T.StructType([T.StructField(f.name, kind(f), True) for f in schema.fields])


def infer_schema(spark: SparkSession, spec: SourceSpec, paths: list[str],
                 groups: dict[tuple, list[str]], persisted: T.StructType | None) -> T.StructType:
    """Typed schema of the given files; no fields if they hold none."""
    if spec.file_format == "csv":
        return _declared(spec, _csv_schema(spark, spec, groups, persisted))
    reader = _reader(spark, spec)
    if spec.file_format != "json":
        reader = reader.option("mergeSchema", "true")
    try:
        schema = reader.format(spec.file_format).load([_literal(p) for p in paths]).schema
    except Exception as exc:  # nothing but empty files
        if _not_found(exc):
            return T.StructType([])
        raise
    fields = T.StructType([f for f in schema.fields if f.name != "_corrupt_record"])
    # Typed files (Parquet, ORC) say what they mean; text formats were guessed.
    return _declared(spec, fields) if spec.file_format == "json" else fields


def merge_schemas(persisted: T.StructType | None, inferred: T.StructType | None) -> T.StructType:
    """Known columns keep their type and position; new columns are appended."""
    if inferred is None:
        return persisted or T.StructType([])
    merged = list(persisted.fields) if persisted else []
    known = {f.name.lower() for f in merged}
    for f in inferred.fields:
        if f.name.lower() not in known:
            known.add(f.name.lower())
            merged.append(f)
    return T.StructType(merged)


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    doc = read_versioned(spark, location)
    return T.StructType.fromJson(doc["schema"]) if doc else None


def save_schema(spark: SparkSession, location: str, schema: T.StructType,
                batch_id: int | None = None) -> None:
    """Persist through Hadoop's file system API, so any shared file system works."""
    write_versioned(spark, location, {"schema": json.loads(schema.json()),
                                      "batch_id": batch_id})


def evolve_schema(spark: SparkSession, spec: SourceSpec, inferred: T.StructType,
                  batch_id: int) -> T.StructType:
    """Merge what the files of a batch hold into the persisted schema, by the evolution mode."""
    persisted = load_schema(spark, spec.schema_location)
    if persisted is not None and spec.options.get("evolution", "add") == "rescue":
        return persisted
    merged = merge_schemas(persisted, inferred)
    if merged.fields and merged != persisted:
        save_schema(spark, spec.schema_location, merged, batch_id)
    return merged


def text_schema(schema: T.StructType, file_format: str = "csv") -> T.StructType:
    """The schema the files are *read* with: every column as raw text or VARIANT.

    JSON: all but string columns are read as VARIANT, which keeps the raw value
    cheaply (reading a JSON number into a string column re-serialises every token
    through a new generator in the multi-line reader - ~15x slower); it is cast right
    after.  CSV: plain strings.  A last column takes the text of records that the
    reader could not take whole.
    """
    fields = []
    for f in schema.fields:
        variant = file_format == "json" and not isinstance(f.dataType, T.StringType)
        fields.append(T.StructField(f.name, T.VariantType() if variant else T.StringType(), True))
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])


def _corrupt(width: int, spec: SourceSpec) -> tuple[str, Column]:
    """What an unparseable record leaves in the rescued map."""
    raw = F.col(CORRUPT)
    if spec.file_format == "json":
        return "_corrupt_record", raw
    # A CSV line with fewer values than columns is complete; one with more is not.
    wide = ", ".join(f"c{i} string" for i in range(width + 1))
    options = {"sep": spec.options.get("delimiter", ",")}
    surplus = F.from_csv(raw, wide, options)[f"c{width}"]
    return "_surplus_values", F.when(raw.isNotNull() & surplus.isNotNull(), raw)


def typed_with_rescue(df: DataFrame, schema: T.StructType, spec: SourceSpec,
                      width: int | None = None) -> DataFrame:
    """Cast raw columns to ``schema``; misfits go to ``_rescued_data`` as JSON.

    Columns of ``df`` beyond the schema are rescued too; those of the schema that the
    files lack are NULL.  ``width``: columns of a CSV header.
    """
    cols: list[Column] = []
    misfits: list[tuple[str, Column]] = [_corrupt(width or len(schema.fields), spec)]
    # Names as they are, then by case: a header may spell a column in another case.
    have = {c.lower(): c for c in df.columns} | {c: c for c in df.columns}
    if spec.file_format != "csv":
        have = {c: c for c in df.columns}
    used = {CORRUPT}
    for f in schema.fields:
        name = have.get(f.name) or have.get(f.name.lower())
        if name is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        used.add(name)
        raw = F.col(f"`{name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(raw.alias(f.name))
            continue
        if isinstance(f.dataType, _ATOMIC):
            text = raw.cast("string")  # VARIANT or STRING -> the value's text
            typed = text.try_cast(f.dataType)
        else:  # nested: kept whole as VARIANT until it is cast
            text = F.when(~F.is_variant_null(raw), F.to_json(raw))
            typed = F.try_variant_get(raw, "$", f.dataType.simpleString())
        cols.append(typed.alias(f.name))
        lost = typed.isNull()
        if not isinstance(f.dataType, _ATOMIC):
            # A nested field that does not fit becomes NULL by itself, and an unknown one
            # goes: both show in the text.  (So does an explicit null; keeping such a
            # value twice loses nothing.)
            lost = lost | (F.to_json(typed) != text)
        misfits.append((f.name, F.when(text.isNotNull() & lost, text)))
    misfits += [(c, F.col(f"`{c}`").cast("string")) for c in df.columns
                if c not in used and not c.startswith("_meta_")]
    m = F.map_filter(F.create_map(*[x for name, v in misfits for x in (F.lit(name), v)]),
                     lambda k, v: v.isNotNull())
    rescued = F.when(F.size(m) > 0, F.to_json(m))
    return df.select(*cols, rescued.alias(RESCUED), *[c for c in df.columns
                                                       if c.startswith("_meta_")])


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumns({INGESTED_AT: F.current_timestamp(),
                           SOURCE_FILE: F.col("_meta_file_name")}).drop("_meta_file_name")


def _named(raw: DataFrame) -> DataFrame:
    return raw.select("*", F.col("_metadata.file_name").alias("_meta_file_name"))


def read_files(spark: SparkSession, spec: SourceSpec, schema: T.StructType, paths: list[str],
               groups: dict[tuple, list[str]], inferred: T.StructType) -> DataFrame:
    """The rows of the given files with bronze columns appended.

    Needs a case-sensitive session: names that differ in case only are read apart.
    """
    fmt = spec.file_format
    if fmt == "csv":
        parts = [typed_with_rescue(_named(_csv_text(spark, spec, names, files)), schema, spec,
                                   len(names)) for names, files in groups.items()]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return with_lineage(out)
    reader = _reader(spark, spec)
    files = [_literal(p) for p in paths]
    if fmt == "json":
        known = {f.name for f in schema.fields}
        more = [T.StructField(f.name, T.VariantType()) for f in inferred.fields
                if f.name not in known]
        read = text_schema(schema, fmt)
        read = T.StructType([*read.fields[:-1], *more, read.fields[-1]])
        raw = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(read).json(files)
        return with_lineage(typed_with_rescue(_named(raw), schema, spec))
    raw = reader.schema(schema).format(fmt).load(files)  # Parquet, ORC: typed files
    return with_lineage(_named(raw).withColumn(RESCUED, F.lit(None).cast("string")).select(
        *schema.names, RESCUED, "_meta_file_name"))


def text_stream(spark: SparkSession, spec: SourceSpec, max_files: int | None = None) -> DataFrame:
    """Stream of the lines of text files, whose schema never changes."""
    reader = spark.readStream.option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.format("text").load(spec.source_path)
    return with_lineage(raw.select("value", F.lit(None).cast("string").alias(RESCUED),
                                   F.col("_metadata.file_name").alias("_meta_file_name")))


def bronze_schema(spark: SparkSession, spec: SourceSpec) -> T.StructType | None:
    """Columns of bronze.<source>, derived from the persisted source schema.

    Lets downstream readers pass an explicit schema instead of discovering it
    from the footers of every file of a growing table.  None before the first run.
    """
    typed = (T.StructType([T.StructField("value", T.StringType())])
             if spec.file_format == "text" else load_schema(spark, spec.schema_location))
    if typed is None:
        return None
    return T.StructType(list(typed.fields) + [
        T.StructField(RESCUED, T.StringType()),
        T.StructField(INGESTED_AT, T.TimestampType()),
        T.StructField(SOURCE_FILE, T.StringType()),
    ])


def bronze_rows(spark: SparkSession, spec: SourceSpec, files: list,
                batch_id: int) -> DataFrame | None:
    """Bronze rows of the files (``path``, ``length``) of a micro-batch; evolves the schema.
    None if the files hold nothing and no schema is known."""
    check_sizes(spec, files)
    paths = sorted(f.path for f in files if f.length > 0)
    if not paths:
        return None
    spark.conf.set("spark.sql.caseSensitive", "true")
    persisted = load_schema(spark, spec.schema_location)
    groups = csv_groups(spark, spec, paths) if spec.file_format == "csv" else {}
    if spec.file_format == "csv" and not groups:
        return None
    inferred = infer_schema(spark, spec, paths, groups, persisted)
    schema = evolve_schema(spark, spec, inferred, batch_id)
    if not schema.fields:
        # Nothing but unparseable records: their text is kept once a schema is known.
        raise ValueError(f"no schema can be inferred for source {spec.source_name!r}: "
                         f"{len(paths)} files, e.g. {paths[0]}, hold no parseable record")
    return read_files(spark, spec, schema, paths, groups, inferred)
