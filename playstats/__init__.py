"""playstats: listening-history analytics written as Spark DataFrame jobs.

Sub-packages
------------
sources    readers for raw exports / landed lookups, and the model built over the driver tables
functions  column-expression helpers (tiers, one-hots, PG-compatible rounding and formatting)
operators  reusable DataFrame operators (ingest, quality, enrichment, ranking, similarity,
           layout, density clustering, labels)
plans      the report, feature and recommendation queries composed from the operators
streaming  Structured Streaming ingestion of daily play drops
checks     DuckDB oracle SQL used by the correctness gate
"""

from playstats.model import Model

__all__ = ["Model"]
