"""Writers: bronze, gold, dated snapshots, reports, run table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_bronze(df: DataFrame, path: str) -> None:
    """Append enriched raw rows under ``ingestion_date=`` folders.

    One run has one date, so the tasks write side by side without a shuffle.
    """
    df.write.mode("append").partitionBy("ingestion_date").parquet(path)


def append_manifest(files: DataFrame, path: str) -> None:
    files.select("path").write.mode("append").parquet(path)


def write_partitioned(df: DataFrame, path: str, column: str) -> None:
    """Replace a table, one folder per value of ``column``.

    Every task may hold every value, so the rows are rebalanced first: that
    gathers a folder into few files, and unlike a plain repartition it lets
    adaptive execution split a folder that holds most of the rows.
    """
    df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(path)


def write_gold(df: DataFrame, path: str, keep_other_dates: bool = False) -> None:
    """Write gold by execution date.

    The whole table is replaced, or only the dates at hand when
    ``keep_other_dates`` is set.  One run has one date: no shuffle.
    """
    scope = "dynamic" if keep_other_dates else "static"
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", scope)
        .partitionBy("pipeline_execution_date")
        .parquet(path)
    )


def write_dated_csv(df: DataFrame, path: str, date: str, partition_column: str) -> None:
    """Snapshot of one run as headed CSV, without the partition column."""
    df.drop(partition_column).write.mode("overwrite").option("header", "true").csv(f"{path}/{date}")


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Headed CSV; ``one_file`` is meant for small dimension tables only."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)

