"""Content fingerprint of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.hashing import hash_number, row_text


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: row count and sum of 48-bit row hashes.

    Independent of row order, file layout and partitioning.
    """
    text = row_text([F.col(c) for c in columns or df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(hash_number(text, 12).cast("decimal(20,0)")).alias("content_sum"),
    )
