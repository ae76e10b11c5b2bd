"""Structured Streaming ingest of daily play drops and a running monthly aggregate."""
