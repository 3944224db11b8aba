"""Structured Streaming into tables: every micro-batch is a commit."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tablekit.catalog import Table


def write_stream(stream: DataFrame, table: Table, checkpoint: str, sequence_field: str | None = None, kind_field: str | None = None) -> DataStreamWriter:
    """A writer to start; a batch that was published before a restart is not published again.

    The snapshot that publishes a batch also records its number for the stream,
    which is known by its whole checkpoint path.
    """
    writer_id = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()

    def commit(batch: DataFrame, number: int) -> None:
        if table.snapshots.latest().streams.get(writer_id, -1) >= number:
            return
        builder = table.new_batch_write_builder()
        writer = builder.new_write()
        writer.write_dataframe(batch, sequence_field, kind_field)
        builder.new_commit().commit(writer.prepare_commit(), stream=(writer_id, number))

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
