"""The change log as a stream."""

from .change_stream import graph_versions, stream_changes

__all__ = ["graph_versions", "stream_changes"]
