"""Trie of conversation prefixes by the Euler-tour technique.

A node is a distinct sequence of first turns; its members are the conversations that
start with it.  Subtree sums come from a tour and not from walking the tree:

1. *Places.*  Turns are ordered through ranges of (conversation, turn), so a conversation
   that holds a third of all rows is several ranges and not one task.
2. *Nodes.*  A prefix is known by two 64-bit hashes, exclusive or over (depth, turn), folded in
   chunks of 2 ** ``CHUNK_BITS`` turns; equal ones are counted before they are shuffled.
3. *Tour.*  Each node has an enter and an exit arc.  The arc after an enter is the first
   child's enter or the own exit; after an exit the next sibling's enter or the parent's
   exit.  Siblings, by smallest member, are linked through ranges too.
4. *Ranks.*  The tour is a linked list, ranked by contraction: in each round an arc whose
   random number is smaller than both neighbours' leaves the list and hands its weights
   to the arc before it.  No two neighbours leave at once, about a third of the arcs do, so rounds
   shrink geometrically, until ``RANKED_AT_ONCE`` arcs are ranked in one task; then the rounds
   are undone, each arc adding its weights to the sum of its successor.
5. *Subtrees.*  The sum over a subtree is the difference of the sums at its enter and exit.

The ids of the conversations that end at a node are hashed as a stream: ranges of the ids
become pieces of text, and a task that hashes a node reads pieces, one after the other.

Turns are ordered by turn (null first), then by role and content; equal rows are turns of
their own.  Null roles and texts are empty.  Rows without a conversation id belong to no conversation.
Conversations without turns are members of the root.  An empty table gives an empty
one.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.staging import stage

CHUNK_BITS = 12
RANKED_AT_ONCE = 1 << 14
# Conversation ids in a piece of text.
IDS_IN_PIECE = 1 << 14
NODE = ["depth", "hash_a", "hash_b"]
WEIGHTS = ["steps", "leaves", "saved"]
NO_ARC = -1


def numbered_turns(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows (conv_id, depth, content, words): each turn's place in its conversation, from 1."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    content = F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"), F.col(turn).alias("turn"), by.alias("role"), content.alias("content"),
        F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("turn"), "role", "content", "row"]
    ranged = rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "ranged-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("conv_id", "part", F.sum("n").over(before).alias("start")).where("start is not null")
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    placed = ranged.withColumn("within", within).join(stage(starts, "starts"), ["conv_id", "part"], "left")
    depth = (F.coalesce("start", F.lit(0)) + F.col("within")).cast("long")
    return stage(placed.select("conv_id", depth.alias("depth"), "content", "words"), "numbered-turns")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, enter, exit.

    ``turns`` has (conv_id, depth, content, words) with depths from 1 without gaps, ``conversations``
    every conv_id once.  ``enter`` and ``exit`` are the places of a node's arcs in the tour.
    """
    prefixes = stage(turn_prefixes(turns), "prefixes")
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("last"))
    zero = F.lit(0).cast("long")
    ends = conversations.select("conv_id").join(last, "conv_id", "left")
    ends = stage(ends.select("conv_id", *[F.coalesce(f"last.{c}", zero).alias(c) for c in NODE]), "ends")
    nodes = stage(with_parents(tree_nodes(prefixes, ends)), "nodes")
    siblings, children = linked_siblings(nodes)
    children = stage(children, "children")
    sums = subtree_sums(tour_arcs(nodes, stage(siblings, "siblings"), children))
    whole = nodes.join(children, "id", "left").join(sums, "id").join(end_hashes(ends), NODE, "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "enter", "exit",
    )


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, hash_a, hash_b, parent_a, parent_b, words), one for each turn."""
    hashed = turns.select(
        "conv_id", "depth", "words", F.shiftright("depth", CHUNK_BITS).alias("chunk"),
        F.xxhash64(F.lit(1), "depth", "content").alias("own_a"), F.xxhash64("content", F.lit(2), "depth").alias("own_b"),
    )
    chunks = hashed.groupBy("conv_id", "chunk").agg(*[F.bit_xor(f"own_{s}").alias(f"of_{s}") for s in "ab"])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select("conv_id", "chunk", *[F.bit_xor(f"of_{s}").over(earlier).alias(f"start_{s}") for s in "ab"])
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = hashed.withColumns({f"sum_{s}": F.bit_xor(f"own_{s}").over(so_far) for s in "ab"})
    joined = inner.join(stage(starts.where("chunk > 0"), "chunk-starts"), ["conv_id", "chunk"], "left")
    whole = {s: F.col(f"sum_{s}").bitwiseXOR(F.coalesce(f"start_{s}", F.lit(0))) for s in "ab"}
    return joined.select(
        "conv_id", "depth", *[whole[s].alias(f"hash_{s}") for s in "ab"],
        *[whole[s].bitwiseXOR(F.col(f"own_{s}")).alias(f"parent_{s}") for s in "ab"], "words",
    )


def tree_nodes(prefixes: DataFrame, ends: DataFrame) -> DataFrame:
    """One row for each distinct prefix, and for the root if there is a conversation."""
    members = [F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")]
    own = prefixes.groupBy(NODE).agg(*members, F.max("words").alias("words"), *[F.min(f"parent_{s}").alias(f"parent_{s}") for s in "ab"])
    zeros = [F.lit(0).cast("long").alias(c) for c in NODE]
    root = ends.agg(*members).where("n_convs > 0")
    nothing = F.lit(None).cast("long")
    root = root.select(*zeros, "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), nothing.alias("parent_a"), nothing.alias("parent_b"))
    return own.unionByName(root)


def with_parents(found: DataFrame) -> DataFrame:
    """Rows (id, depth, hash_a, hash_b, conv_id, n_convs, words, parent, parent_conv_id)."""
    nodes = stage(found.withColumn("id", F.monotonically_increasing_id()), "numbered-nodes")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("hash_a").alias("parent_a"), F.col("hash_b").alias("parent_b"),
        F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
    )
    return nodes.join(above, ["depth", "parent_a", "parent_b"], "left").drop("parent_a", "parent_b")


def linked_siblings(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, previous, following) for each node below another one; (id, first, last, n_children) for each node above one."""
    below = nodes.where("parent is not null").select("id", "parent", "conv_id")
    ranged = stage(below.repartitionByRange("parent", "conv_id").withColumn("part", F.spark_partition_id()), "ranged-siblings")
    place = F.struct("conv_id", "id")
    bounds = stage(
        ranged.groupBy("parent", "part").agg(
            F.min(place)["id"].alias("first"), F.max(place)["id"].alias("last"), F.count(F.lit(1)).alias("n")
        ),
        "sibling-bounds",
    )
    parts = Window.partitionBy("parent").orderBy("part")
    across = bounds.select("parent", "part", F.lag("last").over(parts).alias("before"), F.lead("first").over(parts).alias("after"))
    across = stage(across.where("before is not null or after is not null"), "sibling-seams")
    within = Window.partitionBy("parent", "part").orderBy("conv_id")
    siblings = ranged.withColumns({"lag": F.lag("id").over(within), "lead": F.lead("id").over(within)})
    siblings = siblings.join(across, ["parent", "part"], "left").select(
        "id", F.coalesce("lag", "before").alias("previous"), F.coalesce("lead", "after").alias("following")
    )
    children = bounds.groupBy(F.col("parent").alias("id")).agg(
        F.min(F.struct("part", "first"))["first"].alias("first"),
        F.max(F.struct("part", "last"))["last"].alias("last"),
        F.sum("n").alias("n_children"),
    )
    return siblings, children


def tour_arcs(nodes: DataFrame, siblings: DataFrame, children: DataFrame) -> DataFrame:
    """Rows (arc, pred, succ, steps, leaves, saved); a node's enter is 2 * id and its exit 2 * id + 1."""
    rows = nodes.join(siblings, "id", "left").join(children, "id", "left")

    def enter(node: str) -> Column:
        return F.col(node) * 2

    def leave(node: str) -> Column:
        return F.col(node) * 2 + 1

    none, zero, one = (F.lit(n).cast("long") for n in (NO_ARC, 0, 1))
    saved = (F.col("n_convs") - 1) * F.col("words")
    # Either side of an enter and of an exit arc; a missing node makes its arc null.
    arcs = F.array(
        F.struct(
            enter("id").alias("arc"), F.coalesce(leave("previous"), enter("parent"), none).alias("pred"),
            F.coalesce(enter("first"), leave("id")).alias("succ"), one.alias("steps"),
            F.col("first").isNull().cast("long").alias("leaves"), saved.alias("saved"),
        ),
        F.struct(
            leave("id").alias("arc"), F.coalesce(leave("last"), enter("id")).alias("pred"),
            F.coalesce(enter("following"), leave("parent"), none).alias("succ"), one.alias("steps"),
            zero.alias("leaves"), zero.alias("saved"),
        ),
    )
    return rows.select(F.inline(arcs))


def suffix_sums(arcs: DataFrame) -> DataFrame:
    """Rows (arc, steps, leaves, saved): the weights of an arc and of all after it in its list."""
    rounds = []
    links = stage(arcs, "tour")
    while links.count() > RANKED_AT_ONCE:
        leaves = _leaves(len(rounds))
        rounds.append(links.where(leaves))
        links = stage(_contracted(links, leaves), "tour")
    schema = "arc long, " + ", ".join(f"{w} long" for w in WEIGHTS)
    known = stage(links.withColumn("list", F.lit(0)).groupBy("list").applyInPandas(_rank_at_once, schema), "ranks")
    for gone in reversed(rounds):
        after = known.select(F.col("arc").alias("succ"), *[F.col(w).alias(f"{w}_after") for w in WEIGHTS])
        sums = [(F.col(w) + F.col(f"{w}_after")).alias(w) for w in WEIGHTS]
        known = known.union(stage(gone.join(after, "succ").select("arc", *sums), "ranks"))
    return known


def _leaves(number: int) -> Column:
    """Whether an arc leaves the list in a round; the ends of a list never do."""
    own, before, after = (F.xxhash64(F.col(c), F.lit(number)) for c in ("arc", "pred", "succ"))
    return (F.col("pred") != NO_ARC) & (F.col("succ") != NO_ARC) & (own < before) & (own < after)


def _contracted(links: DataFrame, leaves: Column) -> DataFrame:
    """The arcs that stay, told by those that leave what is now before and after them."""
    gone, none, zero = links.where(leaves), F.lit(None).cast("long"), F.lit(0).cast("long")
    stay = links.where(~leaves).select("arc", "pred", "succ", none.alias("new_pred"), none.alias("new_succ"), *WEIGHTS)
    to_pred = gone.select(F.col("pred").alias("arc"), none, none, none, "succ", *WEIGHTS)
    to_succ = gone.select(F.col("succ").alias("arc"), none, none, "pred", none, zero, zero, zero)
    told = stay.union(to_pred).union(to_succ).groupBy("arc")
    told = told.agg(*[F.max(c).alias(c) for c in ("pred", "succ", "new_pred", "new_succ")], *[F.sum(w).alias(w) for w in WEIGHTS])
    return told.select("arc", F.coalesce("new_pred", "pred").alias("pred"), F.coalesce("new_succ", "succ").alias("succ"), *WEIGHTS)


def _rank_at_once(rows: pd.DataFrame) -> pd.DataFrame:
    place = {arc: i for i, arc in enumerate(rows["arc"])}
    before = {succ: i for i, succ in enumerate(rows["succ"]) if succ != NO_ARC}
    own = rows[WEIGHTS].to_numpy()
    sums = own.copy()
    for i in np.flatnonzero(rows["succ"] == NO_ARC):
        arc = rows["arc"].iloc[i]
        while arc in before:
            after, i = place[arc], before[arc]
            sums[i] = own[i] + sums[after]
            arc = rows["arc"].iloc[i]
    return pd.DataFrame({"arc": rows["arc"], **dict(zip(WEIGHTS, sums.T))})


def subtree_sums(arcs: DataFrame) -> DataFrame:
    """Rows (id, leaves, saved, enter, exit) from the sums at a node's two arcs."""
    leaving = F.col("arc").bitwiseAND(1) == 1
    between = [F.sum(F.when(leaving, -F.col(w)).otherwise(F.col(w))).alias(w) for w in ("leaves", "saved")]
    steps = [F.sum(F.when(leaving == which, F.col("steps"))).alias(name) for name, which in (("enter", False), ("exit", True))]
    ranked = stage(suffix_sums(arcs), "all-ranks")
    length = ranked.agg(F.max("steps")).first()[0]
    per_node = ranked.groupBy(F.shiftright("arc", 1).alias("id")).agg(*between, *steps)
    return per_node.withColumns({c: F.lit(length) - F.col(c) for c in ("enter", "exit")})


def end_hashes(ends: DataFrame) -> DataFrame:
    """Rows (depth, hash_a, hash_b, ends_sha256): the ids that end at a node, rising, joined by commas."""
    order = [*NODE, "conv_id"]
    kinds = "depth long, hash_a long, hash_b long"
    ranged = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stage(ranged.mapInPandas(_pieces, f"{kinds}, first long, ids string"), "end-ids")
    sorted_pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return sorted_pieces.mapInPandas(_hash_pieces, f"{kinds}, ends_sha256 string")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for low in range(0, len(rows), IDS_IN_PIECE):
            part = rows.iloc[low : low + IDS_IN_PIECE]
            grouped = part.groupby(NODE, sort=False)["conv_id"]
            found = [(*node, int(ids.iloc[0]), ",".join(map(str, ids))) for node, ids in grouped]
            yield pd.DataFrame(found, columns=[*NODE, "first", "ids"])


def _hash_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    node, digest = None, None
    for rows in batches:
        found = []
        for *key, ids in zip(*[rows[c] for c in NODE], rows["ids"]):
            if key == node:
                digest.update(f",{ids}".encode())
            else:
                if node is not None:
                    found.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
        yield pd.DataFrame(found, columns=[*NODE, "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=[*NODE, "ends_sha256"])
