"""Matching queries as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def match_stream(queries: DataFrame, match: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                 available_now: bool = False) -> StreamingQuery:
    """Writes the matches of every micro-batch of `queries(query_id, text)` below `out`.

    Matching keeps no state between batches. A batch that is retried after a failure overwrites its
    own folder, so each query's matches appear once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        match(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = queries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
