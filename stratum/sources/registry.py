"""Source registry: which landing folders feed which bronze tables.

The registry is a JSON array of objects (control data, a handful of rows), so
it is the one thing read to the driver: each active entry fans out into one
ingest flow.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

KNOWN_FORMATS = ("json", "csv", "text", "parquet", "orc")


@dataclass(frozen=True)
class SourceSpec:
    source_name: str
    source_path: str
    file_format: str
    schema_location: str
    active: bool = True
    # Optional knobs (the source pipeline names but does not use them).
    options: dict = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    # Declared column types (name -> type); they win over inference.
    types: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.file_format not in KNOWN_FORMATS:
            raise ValueError(f"unsupported file_format {self.file_format!r} for "
                             f"{self.source_name!r}; expected one of {KNOWN_FORMATS}")


_OPTION_KEYS = ("delimiter", "header", "multiline", "evolution", "max_document_bytes")


def load_sources(spark: SparkSession, path: str) -> list[SourceSpec]:
    """Active specs from a registry file (a JSON array of objects)."""
    reg = spark.read.option("multiLine", True).json(path)
    if "active" in reg.columns:
        reg = reg.filter(F.col("active"))
    specs = []
    for row in reg.collect():  # control data: one row per source
        d = row.asDict()
        options = {k: d[k] for k in _OPTION_KEYS if d.get(k) is not None}
        part = d.get("partition_by")
        specs.append(SourceSpec(
            source_name=d["source_name"], source_path=d["source_path"],
            file_format=d["file_format"], schema_location=d["schema_location"],
            active=bool(d.get("active", True)), options=options,
            partition_by=tuple(p.strip() for p in part.split(",")) if part else (),
            types=dict(t.split(":", 1) for t in (d.get("types") or "").split(",") if ":" in t)))
    return specs


def specs_to_json(specs: list[SourceSpec]) -> str:
    """Serialise specs as a registry document (for tests and setup)."""
    import json
    out = []
    for s in specs:
        d = {"active": s.active, "source_name": s.source_name, "source_path": s.source_path,
             "file_format": s.file_format, "schema_location": s.schema_location}
        d.update(s.options)
        if s.partition_by:
            d["partition_by"] = ",".join(s.partition_by)
        if s.types:
            d["types"] = ",".join(f"{k}:{v}" for k, v in s.types.items())
        out.append(d)
    return json.dumps(out, indent=2)
