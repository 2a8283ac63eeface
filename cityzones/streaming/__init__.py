"""Structured Streaming: incremental landing -> formatted zone."""

from cityzones.streaming.landing import (  # noqa: F401
    append_new_rows,
    ingest_incidents,
    ingest_income,
    ingest_rent,
    rent_landing_stream,
    run_incremental,
)
