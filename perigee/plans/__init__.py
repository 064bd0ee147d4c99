"""Composed jobs: the end-to-end pipeline, dashboard reads, and the events-table adapter."""
