"""Structured Streaming jobs: ingest (ST1), live rollup (ST2), live anomalies (ST3)."""
