"""Reusable DataFrame operators: ingest, quality, enrich, ranking, similarity, layout, clusters."""
