"""Structured Streaming jobs: ingest, rollup, snapshot and stateful detectors."""
