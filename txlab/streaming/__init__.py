"""Scoring and drift checks on Structured Streaming, with the batch operators unchanged."""

from .jobs import run_available, stream_drift, stream_score, stream_summary, stream_value_counts, window_drift

__all__ = ["run_available", "stream_drift", "stream_score", "stream_summary", "stream_value_counts", "window_drift"]
