"""DuckDB oracle SQL for the correctness gate (fixture CTEs + one statement per key)."""
