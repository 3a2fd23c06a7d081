"""stratum: a medallion (bronze / silver / gold) payments pipeline on PySpark.

Layout:
  functions/  Column builders (normalisation, rule chains) - pure expressions
  operators/  DataFrame -> DataFrame building blocks (dedup, quarantine, splits)
  plans/      entity pipelines: transactions, merchants, users, gold indicators
  sources/    file sources, source registry, test fixtures, catalog tables
  streaming/  Structured Streaming flows: bronze ingest, silver stages, runner
"""

from stratum.session import build_session, shared_path

__all__ = ["build_session", "shared_path"]
