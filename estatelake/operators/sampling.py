"""Splits, samples and folds by key hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.functions.hashing import hash_bucket, hash_number

# Train share in percent and number of folds.
TRAIN_PERCENT = 80
FOLDS = 3


def with_split(df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Adds ``split``: 'train' or 'test', the same for every copy of a key."""
    train = hash_bucket(F.col(key), 100) < train_percent
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def split_shares(df: DataFrame) -> DataFrame:
    """Rows and percent of each split."""
    # The window runs over the grouped splits: two rows.
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return (
        df.groupBy("split")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("percent", F.col("n_rows") * F.lit(100.0) / total)
    )


def sample_fraction(df: DataFrame, key: str, percent: int) -> DataFrame:
    """About ``percent`` of the keys, independent of the train/test draw."""
    return df.where(hash_bucket(F.col(key), 100, salt="sample-") < percent)


def sample_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Exactly ``rows`` rows (or all, when fewer) in key-hash order.

    Sort and limit run as one top-k, so each task keeps only ``rows`` rows.
    """
    draw = hash_number(F.concat(F.lit("draw-"), F.col(key).cast("string")), 15)
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(rows).drop("_draw")


def with_fold(df: DataFrame, key: str, folds: int = FOLDS) -> DataFrame:
    """Adds ``fold`` 0..folds-1, independent of the train/test draw."""
    return df.withColumn("fold", hash_bucket(F.col(key), folds, salt="fold-"))

