"""Structured Streaming: validate events, keep per-district window counts, sink alerts."""

from blotter.streaming.pipeline import (  # noqa: F401
    build_alert_stream, read_messages, run_available_now, sliding_window_stream,
    trailing_count_stream, validated_stream,
)
