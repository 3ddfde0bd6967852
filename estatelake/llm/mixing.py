"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

Seats are blocks of ``BLOCK_WORDS`` words.  The mix has as many seats as the corpus
has blocks; they go to the sources by highest quotients of the sources' targets (target
over 1, 3, 5, ...).  A source's seats go to its shards in the same way, by their sizes.  A
shard's documents lie one after the other in a seeded order and are cut into blocks; its
quota takes every block as often as it can and then a seeded choice of blocks once
more.  So a document's share of the mix follows from its place in its shard alone.

What reaches the driver is one row for each source.  A shard holds about
``SHARD_WORDS`` words, however large its source is.

Null texts have size 0 and nothing is taken from them; a source without words has target 0.
A null source is a source of its own, the last one.  Rows with equal keys are documents
of their own, and lie one after the other in the same shard.  An empty table gives an empty one.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.staging import stage

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20
MOST_REPEATS = 3
SEED = 11
# A multiplier that has no factor in common with the number of blocks of any shard.
STEP = 2147483647


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Rows (key, source, size, source_size, target, taken); ``weights`` repeat over the sources by code point."""
    words = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sized = stage(docs.select(F.col(key), F.col(source), words.alias("size")), "sized")
    plan = source_plan(sized.groupBy(source).agg(F.sum("size").alias("words")).collect(), weights)
    schema = f"{source} string, source_size long, target double, seats long, shards long"
    sources = docs.sparkSession.createDataFrame(plan, schema)
    joined = _beside(sized, sources, source)
    shard = F.pmod(F.xxhash64(F.lit(SEED), key), F.col("shards"))
    dealt = joined.withColumn("shard", shard).withColumn("draw", F.xxhash64(F.lit(SEED + 1), key))
    quotas = _shard_quotas(dealt, source)
    order = Window.partitionBy(source, "shard").orderBy("draw", key, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("to", F.sum("size").over(order)).withColumn("from", F.col("to") - F.col("size"))
    found = _beside(placed, quotas, source, "shard")
    return found.select(key, source, "size", "source_size", "target", _taken().alias("taken"))


def _beside(rows: DataFrame, other: DataFrame, source: str, *more: str) -> DataFrame:
    """Join on the source, null with null."""
    names = [source, *more]
    renamed = other.select(*[F.col(n).alias(f"{n}__") for n in names], *[c for c in other.columns if c not in names])
    same = [rows[n].eqNullSafe(renamed[f"{n}__"]) for n in names]
    return rows.join(renamed, same).drop(*[f"{n}__" for n in names])


def source_plan(sizes: Sequence, weights: Sequence[float]) -> list[tuple]:
    """(source, size, target, seats, shards) for each (source, size), by code point, null last."""
    rows = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    words = [int(r[1] or 0) for r in rows]
    targets = level_targets(words, [weights[i % len(weights)] for i in range(len(rows))])
    seats = apportion(targets, round(sum(words) / BLOCK_WORDS))
    shards = [max(1, -(-w // SHARD_WORDS)) for w in words]
    return [(r[0], w, float(t), int(s), n) for r, w, t, s, n in zip(rows, words, targets, seats, shards)]


def level_targets(sizes: Sequence[int], weights: Sequence[float]) -> list[float]:
    """Shares of all words by weight, none above ``MOST_REPEATS`` times its source; the excess is reshared."""
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        level = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * level > MOST_REPEATS * sizes[i]]
        for i in full or free:
            targets[i] = float(MOST_REPEATS * sizes[i]) if full else weights[i] * level
        if not full:
            break
        free -= set(full)
        left = sum(sizes) - sum(targets)
    return targets


def apportion(votes: Sequence[float], seats: int) -> np.ndarray:
    """Seats by highest quotients votes / (2 n + 1); of equal quotients the earlier party's first.

    All parties get what a divisor slightly too large gives them, the last
    seats follow one by one.
    """
    votes = np.asarray(votes, dtype=float)
    given = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0 or not votes.sum() > 0:
        return given
    low, high = 0.0, 2 * seats / votes.sum()
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if np.floor(votes * middle + 0.5).sum() <= seats else (low, middle)
    given = np.floor(votes * low * (1 - 1e-12) + 0.5).astype(np.int64)
    # Only parties near their next seat can get one of the last.
    last = seats - int(given.sum())
    queue = [(-v / (2 * int(n) + 1), i) for i, (v, n) in enumerate(zip(votes, given)) if v > 0]
    heapq.heapify(queue)
    for _ in range(last):
        _, i = queue[0]
        given[i] += 1
        heapq.heapreplace(queue, (-votes[i] / (2 * int(given[i]) + 1), i))
    return given


def _shard_quotas(dealt: DataFrame, source: str) -> DataFrame:
    """(source, shard, shard_size, quota): the source's seats shared by shard size; one row each shard."""
    shards = dealt.groupBy(source, "shard", "seats").agg(F.sum("size").alias("shard_size"))

    def share(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard", ignore_index=True)
        rows["quota"] = apportion(rows["shard_size"], int(rows["seats"].iloc[0]))
        return rows[[source, "shard", "shard_size", "quota"]]

    return shards.groupBy(source).applyInPandas(share, f"{source} string, shard long, shard_size long, quota long")


def _taken() -> Column:
    """Words of the document at from..to of its shard that the quota takes, repeats counted."""
    size = F.col("shard_size")
    quota = F.col("quota") * BLOCK_WORDS
    passes = F.least(F.lit(MOST_REPEATS), F.floor(quota / size))
    rest = F.when(passes < MOST_REPEATS, F.ceil((quota - passes * size) / BLOCK_WORDS)).otherwise(0)
    blocks = F.ceil(size / BLOCK_WORDS)
    first, last = F.floor(F.col("from") / BLOCK_WORDS), F.floor((F.col("to") - 1) / BLOCK_WORDS)
    start = F.xxhash64(F.lit(SEED), "shard")

    def chosen(block: Column) -> Column:
        place = F.pmod(block * STEP + F.pmod(start, blocks), blocks)
        words = F.least(F.col("to"), (block + 1) * BLOCK_WORDS) - F.greatest(F.col("from"), block * BLOCK_WORDS)
        return F.when(place < rest, words).otherwise(F.lit(0).cast("long"))

    once = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), lambda total, b: total + chosen(b))
    return F.when(F.col("size") == 0, 0).otherwise(passes * F.col("size") + F.when(rest > 0, once).otherwise(0)).cast("long")


def take(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of the mix: each as often as the whole number of times that it is taken.

    A broken last time counts with a probability of its size, drawn from the key; documents
    without words stay once.  Rows with equal keys are taken equally often.
    """
    times = F.col("taken") / F.col("size")
    draw = F.pmod(F.xxhash64(F.lit(SEED + 2), key), F.lit(1 << 30)) / float(1 << 30)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(times) + (draw < times - F.floor(times)).cast("int"))
    wanted = mixed.groupBy(F.col(key).alias("key__")).agg(F.max(copies).cast("int").alias("copies__"))
    repeated = docs.join(wanted.where("copies__ > 0"), docs[key].eqNullSafe(wanted["key__"]))
    return repeated.withColumn("copy__", F.explode(F.sequence(F.lit(1), F.col("copies__")))).select(docs.columns)
