"""Chat formatting of logged conversations, of which only the longest snapshots are rendered.

A log often holds a conversation after every turn.  Each conversation gets a
rolling hash after each of its turns: two 64-bit hashes, over place, role and text,
folded by exclusive or in one pass over its ordered turns.  A conversation whose last
hash is a hash *within* another one is a prefix of that and goes by an anti-join; of
equal conversations the smallest id stays.  The rest are rendered as one text each.

Only distinct hashes are compared, and they are made distinct before they are
shuffled, so a first turn that all conversations share is one row for each task.

Turns are ordered by turn, role and text, nulls first; equal rows of a conversation
count once.  A null role is rendered as "unknown", a null text as "".  The rows without a
conversation id are one conversation, without an id.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.staging import stage

UNKNOWN_ROLE = "unknown"


def collapse(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, n_turns, kept, n_chars, rendered), the last two null where it is not kept."""
    prefixes = stage(turn_prefixes(turns), "prefixes")
    key = ["place", "hash_a", "hash_b"]
    whole = prefixes.where("place = n_turns").select("conv_id", "n_turns", *key)
    within = prefixes.where("place < n_turns").select(key).distinct()
    first = F.min(F.struct(F.col("conv_id").isNull().alias("last"), "conv_id"))["conv_id"]
    longest = whole.groupBy(key).agg(first.alias("conv_id")).join(within, key, "left_anti")
    texts = rendered(turns.join(_named(longest), turns["conv_id"].eqNullSafe(F.col("kept_id"))).select(turns.columns))
    kept = texts.withColumnRenamed("conv_id", "kept_id").withColumn("kept", F.lit(True))
    return whole.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left").select(
        "conv_id", "n_turns", F.coalesce("kept", F.lit(False)).alias("kept"), F.length("rendered").cast("long").alias("n_chars"), "rendered"
    )


def _named(longest: DataFrame) -> DataFrame:
    return longest.select(F.col("conv_id").alias("kept_id"))


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, place, n_turns, hash_a, hash_b), one for each turn: the hash of all up to it."""
    order = [F.asc_nulls_first(c) for c in ("turn", "role", "text")]
    ordered = Window.partitionBy("conv_id").orderBy(*order)
    again = F.lit(True)
    for column in ("turn", "role", "text"):
        again &= F.lag(column).over(ordered).eqNullSafe(F.col(column))
    first = ~(again & (F.row_number().over(ordered) > 1))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = turns.select("conv_id", "turn", "role", "text", first.alias("new")).withColumn(
        "place", F.sum(F.col("new").cast("long")).over(so_far)
    )
    hashes = {
        f"hash_{name}": F.bit_xor(F.when(F.col("new"), F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text"))).over(so_far)
        for name, seed in (("a", 1), ("b", 2))
    }
    every = Window.partitionBy("conv_id")
    return (
        numbered.withColumns(hashes | {"n_turns": F.max("place").over(every)})
        .where("new")
        .select("conv_id", "place", "n_turns", "hash_a", "hash_b")
    )


def rendered(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, rendered): the turns of each conversation as one text."""
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    text = F.concat_ws("", F.transform("turns", lambda turn: render_turn(turn["role"], turn["text"])))
    return listed.select("conv_id", text.alias("rendered"))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit("<|"), F.coalesce(role, F.lit(UNKNOWN_ROLE)), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n<|end|>\n")
    )
