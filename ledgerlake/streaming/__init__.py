"""Structured Streaming runners: bronze -> silver upsert and the hourly quarantine alarm."""

from ledgerlake.streaming.runners import quarantine_spike_stream, run_bronze_stream, upsert_batch

__all__ = ["quarantine_spike_stream", "run_bronze_stream", "upsert_batch"]
