"""Incremental loads from a streaming source.

Each micro-batch is one load batch of the ``incremental`` mode: it is
prepared, landed, loaded and reconciled exactly like a batch run. The batch
id is derived from a stable prefix and the epoch number, so when Spark
replays an epoch after a failure (from the checkpoint), the replay writes
the same batch id and the dynamic partition overwrite replaces the partial
attempt: the lake and file/catalog targets stay exactly-once.

Each epoch appends its report row to ``report_path`` (parquet), so the run
history is a table, not a log.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewater.constants import INCREMENTAL
from tidewater.plans.ingest import ingest_frame, report_frame


def epoch_batch_id(prefix: str, epoch_id: int) -> str:
    """Sortable batch id of one epoch: ``<prefix><epoch, 10 digits>``."""
    return f"{prefix}{epoch_id:010d}"


def ingest_stream(stream: DataFrame, spec, config, checkpoint_location: str,
                  batch_prefix: str, report_path: str | None = None,
                  available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Start the stream. ``batch_prefix`` must stay the same across restarts
    of the same stream; ``config.batch_id`` is ignored."""
    if not stream.isStreaming:
        raise ValueError("ingest_stream needs a streaming DataFrame (spark.readStream)")

    def per_epoch(batch_df: DataFrame, epoch_id: int) -> None:
        cfg = dataclasses.replace(config, mode=INCREMENTAL,
                                  batch_id=epoch_batch_id(batch_prefix, epoch_id))
        spark = batch_df.sparkSession
        row = ingest_frame(spark, batch_df, spec, cfg)
        if report_path is not None:
            report_frame(spark, [row]).write.mode("append").parquet(report_path)
        if row["status"] == "failed":
            # fail the epoch so Spark retries it instead of moving on
            raise RuntimeError(f"epoch {epoch_id} of {spec.name} failed: {row['reason']}")

    writer = (stream.writeStream.foreachBatch(per_epoch)
              .option("checkpointLocation", checkpoint_location))
    if processing_time is not None:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
