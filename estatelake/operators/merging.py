"""Keyed upsert and union of table parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.operators.cleaning import latest_per_key


def merge_by_key(current: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: a matching key takes all columns of the batch, nulls included.

    Columns the batch lacks keep their value, columns only the batch has are
    added, unmatched rows of either side stay.  Keys must be unique on both
    sides; one shuffle of each side by key.
    """
    joined = current.join(_renamed(batch, keys), keys, "full_outer")
    return joined.select(*keys, *_merged_columns(current, batch, keys))


def merge_newest(
    current: DataFrame, batch: DataFrame, keys: list[str], newest_first: list[Column], unique: bool = False
) -> DataFrame:
    """Upsert in which the newer of two rows gives the columns that both sides have.

    Of equally new rows the batch's counts.  Columns that only one side has come from
    that side.  One shuffle by key; if the columns differ and keys may repeat in ``current`` (it is not
    ``unique``), one more of the batch, for the newest copy of each of its keys.
    """
    if set(current.columns) == set(batch.columns):
        both = union_parts([current.withColumn("_batch", F.lit(False)), batch.withColumn("_batch", F.lit(True))])
        rows = latest_per_key(both, keys, [*newest_first, F.desc("_batch")])
        return rows.select(*keys, *[c for c in current.columns if c not in keys])
    if not unique:
        batch = latest_per_key(batch, keys, newest_first)
    both = union_parts([current.withColumn("_batch", F.lit(False)), batch.withColumn("_batch", F.lit(True))])
    if unique:
        # The row of ``current`` and the newest of the batch, or the two newest: all others go before the shuffle.
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_batch", *newest_first))
        both = both.withColumn("_place", place).where("_place <= 2").drop("_place")
    order = Window.partitionBy(*keys).orderBy(*newest_first, F.desc("_batch"))
    ranked = both.withColumn("_rank", F.row_number().over(order))
    shared = [c for c in current.columns if c in batch.columns and c not in keys]
    sides = {
        "_newest": (F.lit(True), shared),
        "_old": (~F.col("_batch"), [c for c in current.columns if c not in batch.columns]),
        "_new": (F.col("_batch"), [c for c in batch.columns if c not in current.columns]),
    }
    picked = {n: (where, columns) for n, (where, columns) in sides.items() if columns}
    rows = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.min_by(F.struct(*c), F.when(w, F.col("_rank"))).alias(n) for n, (w, c) in picked.items()],
    )
    return rows.select(*keys, *[F.col(n)[c].alias(c) for n, (_, columns) in picked.items() for c in columns])


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def _renamed(batch: DataFrame, keys: list[str]) -> DataFrame:
    return batch.select(
        *keys,
        *[F.col(c).alias(f"_new_{c}") for c in batch.columns if c not in keys],
        F.lit(True).alias("_hit"),
    )


def _merged_columns(current: DataFrame, batch: DataFrame, keys: list[str]):
    old = [c for c in current.columns if c not in keys]
    new = [c for c in batch.columns if c not in keys]
    merged = []
    for name in old:
        if name in new:
            value = F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name))
            merged.append(value.alias(name))
        else:
            merged.append(F.col(name))
    return merged + [F.col(f"_new_{name}").alias(name) for name in new if name not in old]
