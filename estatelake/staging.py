"""Written intermediate tables in the shared folder of the cluster.

A staged table cuts the lineage (a lost executor re-reads files instead of
recomputing the joins above it), and its size on storage is what the planner
compares with ``spark.sql.autoBroadcastJoinThreshold``: small staged tables are
broadcast, large ones are not, and nothing has to be guessed.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from estatelake.folders import remove_folder

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="estatelake-")
    return _local_dirs[app]


def staging_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call returns."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/estatelake/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, by: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return the written table.

    With ``by``, each value of that column gets a folder of its own, so that a
    filter on it reads nothing else.  A wide table may name its ``compression``.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    _write(df, path, by, compression)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(**frames: DataFrame) -> dict[str, DataFrame]:
    """Stage independent frames at the same time; Spark shares the cluster among them."""
    with ThreadPoolExecutor(len(frames)) as pool:
        tables = pool.map(lambda item: stage(item[1], item[0]), frames.items())
        return dict(zip(frames, tables))


@contextmanager
def staged(df: DataFrame, label: str, by: str | None = None) -> Iterator[DataFrame]:
    """Like ``stage``, for a table that is only needed inside the block."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    _write(df, path, by)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def broadcast_limit(spark: SparkSession) -> int:
    """The size up to which the planner broadcasts a written table; -1 for never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def release(spark: SparkSession) -> None:
    """Delete every staged table of this application."""
    app = spark.sparkContext.applicationId
    remove_folder(spark, f"{shared_dir(spark)}/estatelake/{app}")


def _write(df: DataFrame, path: str, by: str | None, compression: str | None = None) -> None:
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path, compression=compression)
