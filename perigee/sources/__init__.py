"""Readers and writers: wire messages, telemetry table, labels, marts and events."""
