"""Near-duplicate groups by one-permutation hashing, bands and star-shaped candidates.

A document is the set of its distinct word shingles.  One hash of each shingle
picks a bin and a value; a bin keeps its least value, and an empty bin takes that
of a donor bin found by a fixed random sequence of its own (optimal densification).
Bands of bins are buckets.  A bucket never lists its pairs: each member is linked
to one centre.

1. Documents with the same set are one class, represented by its first row.
2. First stars: the centre of a bucket is its first class, so near copies mostly
   share a centre.  Links are confirmed on the full sets.
3. Second stars, only in buckets that still hold several groups: the centre is the
   member that shares its buckets with most others, such as the text that many
   were copied from; members of other groups than the centre's are tested.
4. The rest: a centre has met its bucket and leaves it.  Where members of several
   groups remain, all pairs of different groups meet in tiles.  So every two
   documents that share a bucket are compared or are in one group anyway.

Sets are made again from the texts where a pair needs them, and meet per centre
in portions, or per pair of parts of a bucket in tiles, of bounded size.  The pairs of
the largest group of a bucket are never listed; the others cost tiles by the
square of their shingles.

Null and empty texts have an empty set and are linked with nothing.  Rows with
the same id each get a row.  A null id is larger than all others in choosing
representatives, and is the component only of a group without any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from estatelake.llm.blocks import ROW_BITS, Blocks, block_rows, whole_rows, write_blocks
from estatelake.llm.components import connected_components
from estatelake.llm.text_arrays import Hasher, finish
from estatelake.staging import stage

BINS, ROWS_PER_BAND = 128, 4
BANDS = BINS // ROWS_PER_BAND
# Shingles of the members that meet a centre in one task.
PORTION = 1 << 16
# Shingles of one of the two parts of a bucket that meet in a tile.
PART = 1 << 18
# Bytes of sets in one Arrow batch.
BATCH_BYTES = 4 << 20
SIGNED = "node long, id long, n_shingles long, set_a long, set_b long, bands array<long>"


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, least: tuple[int, int] = (85, 100)
) -> DataFrame:
    """Rows (key, n_shingles, component_id, kept, keeper).

    Linked are documents with ``least[1] * intersection >= least[0] * union`` of their
    sets.  ``component_id`` is the smallest key of the group; ``keeper`` marks
    one row of each group.
    """
    _, judged = _judged(docs, key, text, width, least, ())
    alone = F.col("head").isNull()
    return judged.select(
        F.col("id").alias(key),
        "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("id").eqNullSafe(F.col("head.id"))).alias("kept"),
        F.when(alone, True).otherwise(F.col("node") == F.col("head.node")).alias("keeper"),
    )


def one_of_each_group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: tuple[int, int] = (80, 100)
) -> DataFrame:
    """The rows of ``docs`` without those that a near duplicate stands for; texts without words all stay."""
    carry = [c for c in docs.columns if c not in (key, text)]
    blocks, judged = _judged(docs, key, text, width, least, carry)
    gone = judged.where("node <> head.node").select(
        F.shiftright("node", ROW_BITS).alias("block"),
        F.col("node").bitwiseAND((1 << ROW_BITS) - 1).cast("int").alias("gone"),
    )
    listed = gone.groupBy("block").agg(F.collect_list("gone").alias("gone"))
    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema.fields])
    return blocks.frame().join(listed, "block", "left").mapInArrow(_staying(key, text, docs.columns), schema)


def _judged(docs: DataFrame, key: str, text: str, width: int, least: tuple[int, int], carry) -> tuple[Blocks, DataFrame]:
    """The blocks, and for each document its first representative as ``head``, null without shingles."""
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = write_blocks(docs, key, text, n_bytes, "near-blocks", carry)
    signed = stage(blocks.frame().mapInArrow(_signatures(width), SIGNED), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "node"))
    sets = ["set_a", "set_b", "n_shingles"]
    classes = stage(signed.where("n_shingles > 0").groupBy(sets).agg(first.alias("first")), "set-classes")
    leaders = classes.select(F.col("first.node").alias("node"))
    members = stage(_bucket_members(signed.join(leaders, "node", "left_semi")), "bucket-members")
    links = _links(members, blocks, width, least)
    groups = _with_group(classes.withColumn("node", F.col("first.node")), links)
    heads = groups.groupBy("group").agg(F.min("first").alias("head"))
    by_class = groups.join(heads, "group").select(*sets, "head")
    return blocks, signed.join(by_class, sets, "left")


def _bucket_members(signed: DataFrame) -> DataFrame:
    """Rows (band, bucket, node, n_shingles) of all buckets with two members or more."""
    rows = signed.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    full = rows.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(full.drop("n"), ["band", "bucket"])


def _links(members: DataFrame, blocks: Blocks, width: int, least: tuple[int, int]) -> DataFrame:
    centres = stage(members.groupBy("band", "bucket").agg(F.min("node").alias("centre")), "first-centres")
    tried = stage(_stars(members, centres), "first-stars")
    links = stage(_confirmed(tried, blocks, width, least), "first-links")
    grouped = stage(_mixed(_with_group(_without(members, centres), links)), "grouped-members")
    load = grouped.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"))
    met = grouped.join(load, ["band", "bucket"]).groupBy("node").agg(F.sum("n").alias("met"))
    rank = F.struct("met", F.xxhash64("node", "band").alias("draw"), "node", "group")
    mixed = grouped.join(met, "node").groupBy("band", "bucket").agg(F.max(rank).alias("drawn")).select(
        "band", "bucket", F.col("drawn.node").alias("centre"), F.col("drawn.group").alias("its_group")
    )
    mixed = stage(mixed, "second-centres")
    more = _stars(grouped, mixed, "group <> its_group")
    pair = [F.least("centre", "node").alias("low"), F.greatest("centre", "node").alias("high")]
    done = tried.select(*pair)
    untried = more.select(*more.columns, *pair).join(done, ["low", "high"], "left_anti").drop("low", "high")
    second = _confirmed(stage(untried, "second-stars"), blocks, width, least)
    links = stage(links.union(second), "star-links")
    left = _without(grouped.drop("group"), mixed)
    rest = stage(_mixed(_with_group(left, links)), "rest-members")
    if rest.isEmpty():
        return links
    return links.union(_rest_links(rest, blocks, width, least))


def _without(members: DataFrame, centres: DataFrame) -> DataFrame:
    """The members without the centre of each bucket, which has met the others."""
    kept = members.join(centres.select("band", "bucket", "centre"), ["band", "bucket"], "left")
    return kept.where("centre is null or node <> centre").drop("centre")


def _mixed(grouped: DataFrame) -> DataFrame:
    """The members of the buckets that hold several groups."""
    mixed = grouped.groupBy("band", "bucket").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    return grouped.join(mixed.where("low <> high").select("band", "bucket"), ["band", "bucket"], "left_semi")


def _rest_links(rest: DataFrame, blocks: Blocks, width: int, least: tuple[int, int]) -> DataFrame:
    """Links between members of different groups that share a bucket; all of them are compared.

    The largest group of a bucket is dealt to parts of its own, which meet the parts of the others only.
    """
    bucket = ["band", "bucket"]
    by_group = stage(
        rest.groupBy(*bucket, "group").agg(
            F.sum("n_shingles").alias("load"),
            F.count(F.lit(1)).alias("n"),
            F.expr("bit_xor(xxhash64(node))").alias("mark"),
            F.expr("bit_xor(xxhash64(node, 7))").alias("other_mark"),
        ),
        "rest-groups",
    )
    buckets = by_group.groupBy(*bucket).agg(
        F.max(F.struct("load", "group")).alias("main"),
        F.sum("load").alias("load"),
        F.sum("n").alias("n"),
        F.expr("bit_xor(mark)").alias("mark"),
        F.expr("bit_xor(other_mark)").alias("other_mark"),
    )
    # Buckets of several bands with the same members count once.
    once = buckets.groupBy("n", "mark", "other_mark").agg(F.min(F.struct(*bucket, "main", "load")).alias("b"))
    # Few members meet at once, the main group among them.
    small = F.col("b.load") <= PART
    once = once.select(
        "b.band",
        "b.bucket",
        F.when(~small, F.col("b.main.group")).alias("main"),
        F.when(small, 1).otherwise(F.ceil((F.col("b.load") - F.col("b.main.load")) / PART)).cast("int").alias("parts"),
        F.when(small, 0).otherwise(F.ceil(F.col("b.main.load") / PART)).cast("int").alias("main_parts"),
    )
    once = stage(once, "rest-buckets")
    in_main = F.col("group").eqNullSafe(F.col("main"))
    part = F.when(in_main, F.col("parts") + F.pmod(F.xxhash64("node"), F.greatest("main_parts", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("node"), "parts")
    )
    rows = rest.join(once, bucket).withColumn("in_main", in_main).withColumn("part", part.cast("int"))
    last = F.when(F.col("in_main"), F.col("parts") - 1).otherwise(F.col("parts") + F.col("main_parts") - 1)
    dealt = rows.select(
        F.xxhash64("band", "bucket").alias("tile"), "node", "group", "part", F.explode(F.sequence(F.lit(0), last)).alias("meets")
    )
    dealt = stage(
        dealt.select("node", "tile", F.least("part", "meets").alias("low"), F.greatest("part", "meets").alias("high"), "part", "group"),
        "rest-tiles",
    )
    sets = _sets(dealt, blocks, width, {"tile": "long", "low": "int", "high": "int", "part": "int", "group": "long"})
    return sets.groupBy("tile", "low", "high").applyInPandas(_compare_parts(least), "low long, high long")


def _stars(members: DataFrame, centres: DataFrame, where: str = "true") -> DataFrame:
    """Distinct candidate pairs (centre, node, n_shingles)."""
    pairs = members.join(centres, ["band", "bucket"]).where(where).where("node <> centre")
    return pairs.select("centre", "node", "n_shingles").distinct()


def _with_group(rows: DataFrame, links: DataFrame) -> DataFrame:
    components = stage(connected_components(links), "groups")
    joined = rows.join(components, "node", "left")
    return joined.withColumn("group", F.coalesce("component", "node")).drop("component")


def _confirmed(pairs: DataFrame, blocks: Blocks, width: int, least: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    load = pairs.groupBy("centre").agg(F.sum("n_shingles").alias("load"))
    portions = F.ceil(F.col("load") / PORTION).cast("int")
    dealt = pairs.join(load, "centre").select(
        "centre", "node", F.pmod(F.xxhash64("node"), portions).cast("int").alias("portion")
    )
    dealt = stage(dealt, "dealt-pairs")
    heads = dealt.select("centre", F.col("centre").alias("node"), "portion").distinct()
    sets = _sets(dealt.union(heads.select(*dealt.columns)), blocks, width, {"centre": "long", "portion": "int"})
    return sets.groupBy("centre", "portion").applyInPandas(_compare(least), "low long, high long")


def _sets(rows: DataFrame, blocks: Blocks, width: int, columns: dict[str, str]) -> DataFrame:
    """The ``columns`` of the rows, long or int, beside their node and its set."""
    wanted = rows.select(
        F.shiftright("node", ROW_BITS).alias("block"),
        F.struct(F.col("node").bitwiseAND((1 << ROW_BITS) - 1).cast("int").alias("row"), *columns).alias("to"),
    )
    asked = blocks.frame().join(wanted.groupBy("block").agg(F.collect_list("to").alias("wanted")), "block")
    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    return asked.mapInArrow(_wanted_sets(width, columns), f"{schema}, node long, shingles binary")


def shingle_sets(hasher: Hasher, data: np.ndarray, starts: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, _, _, before = hasher.words(data, starts)
    rolled = hashes.copy()
    for step in range(1, width):
        full = max(0, len(hashes) - step)
        rolled[:full] = finish(rolled[:full] ^ hashes[step:] * np.uint64(2 * step + 1))
    sets = []
    for low, high in zip(before[:-1], before[1:]):
        if high - low >= width:
            sets.append(np.unique(rolled[low : high - width + 1]))
        elif high > low:
            whole = np.array([high - low], dtype=np.uint64)
            for word in hashes[low:high]:
                whole = finish(whole + word)
            sets.append(whole)
        else:
            sets.append(hashes[:0])
    return sets


def signature(sets: list[np.ndarray], donors: np.ndarray) -> np.ndarray:
    """Least value of each bin for each set that is not empty, empty bins filled from donors."""
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    bits = np.uint64(64 - (BINS.bit_length() - 1))
    place = np.repeat(np.arange(len(sets)), sizes) * BINS + (every >> bits).astype(np.int64)
    # Sets are sorted, so the first of each bin is its least.
    at, first = np.unique(place, return_index=True)
    table = np.zeros(len(sets) * BINS, dtype=np.uint64)
    filled = np.zeros(len(sets) * BINS, dtype=bool)
    table[at], filled[at] = every[first], True
    table, filled = table.reshape(-1, BINS), filled.reshape(-1, BINS)
    row, bin_ = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        donor = donors[attempt % len(donors)][bin_]
        found = filled[row, donor]
        table[row[found], bin_[found]] = table[row[found], donor[found]]
        row, bin_, attempt = row[~found], bin_[~found], attempt + 1
    return table


def donor_table() -> np.ndarray:
    """For each attempt a bin for each empty bin; every bin is tried in the end."""
    draws = np.random.default_rng(20240229)
    return np.stack([draws.permutation(BINS) for _ in range(BINS)], axis=1)


def _signatures(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, donors = Hasher(), donor_table()
        for row, data, starts in block_rows(batches):
            sets = shingle_sets(hasher, data, starts, width)
            table = signature(sets, donors).reshape(-1, BANDS, ROWS_PER_BAND)
            bands = np.zeros(table.shape[:2], dtype=np.uint64)
            for column in range(ROWS_PER_BAND):
                bands = finish(bands * np.uint64(3) + table[:, :, column])
            sums = [[int(finish(s + np.uint64(salt)).sum(dtype=np.uint64)) for s in sets] for salt in (1, 2)]
            nodes = (row["block"].as_py() << ROW_BITS) + np.arange(len(sets))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(row["ids"].as_py(), pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(np.array(s, dtype=np.uint64).view(np.int64)) for s in sums),
                    lists,
                ],
                ["node", "id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return work


def _wanted_sets(width: int, columns: dict[str, str]):
    names = [*columns, "node", "shingles"]
    kinds = [*(pa.int64() if kind == "long" else pa.int32() for kind in columns.values()), pa.int64(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for row, data, starts in block_rows(batches):
            wanted = sorted(row["wanted"].as_py(), key=lambda w: w["row"])
            rows = sorted({w["row"] for w in wanted})
            part = np.concatenate([data[starts[r] : starts[r + 1]] for r in rows])
            sizes = np.array([starts[r + 1] - starts[r] for r in rows])
            sets = dict(zip(rows, shingle_sets(hasher, part, np.concatenate([[0], np.cumsum(sizes)]), width)))
            out, room = [], BATCH_BYTES
            for w in wanted:
                node = (row["block"].as_py() << ROW_BITS) + w["row"]
                out.append((*(w[c] for c in columns), node, sets[w["row"]].tobytes()))
                room -= len(out[-1][-1])
                if room < 0:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out, room = [], BATCH_BYTES
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return work


def _compare(least: tuple[int, int]):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        centre = rows["centre"].iloc[0]
        own = np.frombuffer(rows.loc[rows["node"] == centre, "shingles"].iloc[0], dtype=np.uint64)
        linked = []
        for node, shingles in zip(rows["node"], rows["shingles"]):
            if node != centre:
                other = np.frombuffer(shingles, dtype=np.uint64)
                place = np.searchsorted(own, other)
                shared = int(np.count_nonzero(own[np.minimum(place, len(own) - 1)] == other))
                if least[1] * shared >= least[0] * (len(own) + len(other) - shared):
                    linked.append(node)
        return pd.DataFrame({"low": [min(centre, n) for n in linked], "high": [max(centre, n) for n in linked]}, dtype="int64")

    return work


def _compare_parts(least: tuple[int, int]):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, groups, part = (rows[c].to_numpy().copy() for c in ("node", "group", "part"))
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"]]
        sizes = np.array([len(s) for s in sets])
        _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
        # The members that hold each shingle, one after another.
        holder = np.repeat(np.arange(len(sets)), sizes)[np.argsort(shingle, kind="stable")]
        ends = np.cumsum(np.bincount(shingle))
        linked = []
        for member, own in enumerate(np.split(shingle, np.cumsum(sizes)[:-1])):
            if part[member] != low:
                continue
            others = (part == high) & (groups != groups[member])
            if low == high:
                others[:member] = False
            if not others.any():
                continue
            met = np.concatenate([holder[ends[s - 1] if s else 0 : ends[s]] for s in own])
            shared = np.bincount(met, minlength=len(sets))
            near = np.flatnonzero(others & (least[1] * shared >= least[0] * (sizes + sizes[member] - shared)))
            # One link joins a group.
            joined, first = np.unique(groups[near], return_index=True)
            linked += [(nodes[member], nodes[near[f]]) for f in first]
            groups[np.isin(groups, joined)] = groups[member]
        return pd.DataFrame({"low": [min(p) for p in linked], "high": [max(p) for p in linked]}, dtype="int64")

    return work


def _staying(key: str, text: str, columns: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, data, starts in block_rows(batches):
            rows = np.setdiff1d(np.arange(len(starts) - 1), row["gone"].as_py() or [])
            texts = [data[starts[r] : starts[r + 1]].tobytes() for r in rows]
            yield whole_rows(row, texts, rows, key, text, columns)

    return work
