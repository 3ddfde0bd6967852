"""Incremental ingest of raw drops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from estatelake.sources import files


def bronze_stream(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """Enriched raw rows of new files; corrupt records keep their text."""
    enriched = files.with_lineage(files.stream_raw(spark, source, folder))
    return files.with_file_year(enriched) if source == "listings" else enriched


def ingest(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything new to bronze, then stop.

    The checkpoint knows the files already taken, and the file sink's log makes
    each of them count once even when a run is repeated after a failure.
    """
    return (
        rows.writeStream.format("parquet")
        .partitionBy("ingestion_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def ingest_csv(
    spark: SparkSession, source: str, folder: str, path: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Append new CSV files to bronze, each read by its own header, then stop.

    A micro-batch tells which files are new; they are read as in batch, so columns in another
    order keep their names.  Each batch has a folder of its own and replaces it when it runs again.
    """
    options = {"maxFilesPerTrigger": str(max_files)} if max_files is not None else {}
    names = spark.readStream.format("text").options(**options, recursiveFileLookup="true").load(folder)

    def append(batch: DataFrame, batch_id: int) -> None:
        # A reader holds the paths of its files on the driver in any case.
        paths = [r[0] for r in batch.select("file").distinct().collect()]
        if paths:
            rows = files.with_lineage(files.read_raw(batch.sparkSession, source, paths))
            rows.write.mode("overwrite").partitionBy("ingestion_date").parquet(f"{path}/batch={batch_id}")

    return (
        names.select(F.col("_metadata.file_path").alias("file"))
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
