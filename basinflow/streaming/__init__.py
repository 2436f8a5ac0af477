"""Structured Streaming entry points (incremental, resumable sample builds)."""

from .incremental import build_batch, flow_file_stream, incremental_build, landed_flow

__all__ = ["build_batch", "flow_file_stream", "incremental_build", "landed_flow"]
