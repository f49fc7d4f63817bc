"""Streaming form of the landing step (new survey files as they arrive)."""

from paysight.streaming.landing import land_files, land_stream, new_files

__all__ = ["land_files", "land_stream", "new_files"]
