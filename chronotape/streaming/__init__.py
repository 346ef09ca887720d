"""Structured Streaming forms of the batch operators."""

from chronotape.streaming.bars import raw_print_stream, session_stream_bars, stream_bars, write_stream
from chronotape.streaming.events import dedupe_order_event_stream, split_late_rows
from chronotape.streaming.provisional import latest_versions, provisional_bars, write_versions

__all__ = [
    "dedupe_order_event_stream", "latest_versions", "provisional_bars", "raw_print_stream", "session_stream_bars",
    "split_late_rows", "stream_bars", "write_stream", "write_versions",
]
