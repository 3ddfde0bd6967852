"""Valuation of a stream of requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from estatelake.operators import models

RESPONSES, REJECTED = "responses", "rejected"


def score_stream(
    requests: DataFrame, model: PipelineModel, rmse: float, path: str, checkpoint: str
) -> StreamingQuery:
    """Score everything new, write responses and rejected requests below ``path``, then stop.

    Each output has a folder for each batch, so a batch that runs again after a failure
    replaces what it wrote before.  Scoring is row by row: the batch operator serves
    streams unchanged.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for name, rows in zip((RESPONSES, REJECTED), models.score_or_reject(batch, model, rmse)):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_output(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of all batches of one output."""
    return spark.read.parquet(f"{path}/{name}").drop("batch")
