"""Structured Streaming variants of the file pickers."""

from tidelake.streaming.landing import stream_land, stream_raw_to_cleansed

__all__ = ["stream_land", "stream_raw_to_cleansed"]
