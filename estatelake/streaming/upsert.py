"""Incremental keyed upsert into a silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from estatelake.sources.silver import SilverTable

# Fixed value: where Spark says which stream a batch is of; it stays through restarts from a checkpoint.
STREAM_ID = "sql.streaming.queryId"


def upsert(rows: DataFrame, table: SilverTable, newest_first: list[Column], checkpoint: str) -> StreamingQuery:
    """Merge every micro-batch by key, then stop when nothing new is left.

    The table keeps, with each commit, the last batch of each stream.  A batch that runs again
    after a failure finds itself there and adds neither a version nor rejected rows.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty(STREAM_ID)
        table.upsert(batch, newest_first, source=(stream, batch_id) if stream else None)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
