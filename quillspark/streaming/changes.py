"""The changes of an index as a stream: whoever keeps something derived from the documents hears of every commit once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quillspark.sources.versions import IndexDirectory


def change_stream(directory: IndexDirectory, apply: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """A writer that calls ``apply(changes, version)`` for what was committed since it last ran, in order; set a trigger and
    ``start()`` it. Commits that are found together come as one change up to the last of them.

    After a failure a call may come again with the same version; ``apply`` must then change nothing more."""

    def each(commits: DataFrame, batch_id: int) -> None:
        first, last = commits.agg(F.min("version"), F.max("version")).first()
        if last:
            apply(directory.changes(max(0, first - 1), last), last)

    return directory.commits().writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
