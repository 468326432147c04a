"""A stream of records into an index directory: every micro-batch is one commit.

A micro-batch that Spark replays after a failure is recognised by its id in the commit log, so each
record takes effect once. With ``upsert`` the newest record of a key, by a column that says so, replaces the others.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from quillspark.sources.versions import IndexDirectory


def index_stream(
    records: DataFrame,
    directory: IndexDirectory,
    checkpoint: str,
    stream: str = "stream",
    upsert: bool = True,
    order_by: str | None = None,
) -> DataStreamWriter:
    """A writer that commits every micro-batch; set a trigger and ``start()`` it.

    An upsert needs ``order_by``, a field kept with the documents: micro-batches may come in any order of it."""
    if upsert and order_by is None:
        raise ValueError("a stream of upserts needs order_by, the field by which one record is newer than another")

    def commit(batch: DataFrame, batch_id: int) -> None:
        if directory.has_stream_batch(stream, batch_id):
            return
        # Read more than once below: to find what it replaces, and to write it.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if upsert:
                directory.upsert(batch, (stream, batch_id), order_by)
            else:
                directory.append(batch, (stream, batch_id))
        finally:
            batch.unpersist()

    return records.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)


def without_replays(records: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop records a source sends again within ``delay``; state older than that is forgotten."""
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
