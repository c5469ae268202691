"""Incremental loads driven by Structured Streaming micro-batches."""

from tidewater.streaming.micro_batch import ingest_stream, epoch_batch_id

__all__ = ["ingest_stream", "epoch_batch_id"]
