"""Line dedup by pairwise alignment: blocks of lines that an earlier document has go from the later one.

1. Anchors are lines of ``LEAST_WORDS`` words or more that occur once in their
   document and in another document too: rare enough not to meet by chance.
2. Every document is paired with the first document that has one of its anchors,
   for each anchor.  So a line in a third of all documents gives a star of pairs and
   never all pairs, and no line is too frequent to count.
3. A pair is aligned by patience diff: equal beginnings and ends, then the longest
   rising run of lines that are unique in both, then the gaps between them.
4. Aligned runs of lines with ``LEAST_WORDS`` words together go from the later
   document.  Runs are found in the input: removals do not depend on each other.

Lines are compared without white space at their ends.  Earlier is the smaller key,
null last, then the order of reading; rows with equal keys are documents of their own.
Null and empty texts have no lines and stay as empty texts.  A document whose lines all go stays as an
empty text.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from estatelake.llm.blocks import ROW_BITS, block_rows, whole_rows, write_blocks
from estatelake.staging import stage

LEAST_WORDS = 5
# Lines of the documents that meet a first document in one task.
PORTION = 1 << 13
LINED = "node long, id long, lines array<long>, words array<int>, anchors array<long>"


def remove_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_lines, n_removed, kept_text, kept_sha256)."""
    schema = f"{key} long, n_lines long, n_removed long, kept_text string, kept_sha256 string"
    return _blocks_and_places(docs, key, text, ()).mapInArrow(_kept(key), schema)


def without_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with their texts cut; a text that loses its last word so goes as a whole."""
    carry = [c for c in docs.columns if c not in (key, text)]
    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema.fields])
    return _blocks_and_places(docs, key, text, carry).mapInArrow(_cut_rows(key, text, docs.columns), schema)


def _blocks_and_places(docs: DataFrame, key: str, text: str, carry: Sequence[str]) -> DataFrame:
    """The blocks of the corpus beside the places of the lines that go."""
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = write_blocks(docs, key, text, n_bytes, "line-blocks", carry)
    lined = stage(blocks.frame().mapInArrow(_lines, LINED), "lines")
    pairs = stage(_pairs(lined), "line-pairs")
    gone = _aligned(pairs, lined)
    by_row = gone.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))
    by_row = by_row.select(
        F.shiftright("node", ROW_BITS).alias("block"),
        F.struct(F.col("node").bitwiseAND((1 << ROW_BITS) - 1).cast("int").alias("row"), "lines").alias("gone"),
    )
    listed = by_row.groupBy("block").agg(F.collect_list("gone").alias("gone"))
    return blocks.frame().join(listed, "block", "left")


def _pairs(lined: DataFrame) -> DataFrame:
    """Distinct (centre, node, n_lines): a document and the first one with an anchor of it."""
    anchors = lined.select(
        "node",
        F.struct(F.col("id").isNull().alias("last"), "id", "node").alias("place"),
        F.size("lines").alias("n_lines"),
        F.explode("anchors").alias("line"),
    )
    first = anchors.groupBy("line").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # A written table, so that the join can split a line that very many documents have.
    owners = stage(first.select("line", F.col("first.node").alias("centre")), "line-owners")
    met = anchors.join(owners, "line").where("node <> centre")
    return met.select("centre", "node", "n_lines").distinct()


def _aligned(pairs: DataFrame, lined: DataFrame) -> DataFrame:
    """(node, lines): places of the lines that a pair removes from the later document."""
    load = pairs.groupBy("centre").agg(F.sum("n_lines").alias("load"))
    portions = F.ceil((F.col("load") + 1) / PORTION).cast("int")
    portion = F.pmod(F.xxhash64("node"), portions).cast("int")
    dealt = stage(pairs.join(load, "centre").select("centre", "node", portion.alias("portion")), "dealt-lines")
    heads = dealt.select("centre", F.col("centre").alias("node"), "portion").distinct()
    meeting = dealt.union(heads).join(lined.select("node", "lines", "words"), "node")
    return meeting.groupBy("centre", "portion").applyInPandas(_align_group, "node long, lines array<int>")


def _align_group(rows: pd.DataFrame) -> pd.DataFrame:
    centre = rows["centre"].iloc[0]
    own = rows.loc[rows["node"] == centre, "lines"].iloc[0].tolist()
    found = []
    for node, lines, words in zip(rows["node"], rows["lines"], rows["words"]):
        if node != centre:
            places = shared_lines(own, lines.tolist(), words.tolist())
            if places:
                found.append((node, places))
    return pd.DataFrame(found, columns=["node", "lines"])


def shared_lines(earlier: list, later: list, words: list[int]) -> list[int]:
    """Places in ``later`` of the aligned runs that have enough words."""
    found: list[int] = []
    run: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(earlier, later), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in run) >= LEAST_WORDS:
                found += run
            run = []
        run.append(j)
        last = (i, j)
    return found


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of equal items, rising in both lists."""
    found: list[tuple[int, int]] = []
    open_parts = [(0, len(a), 0, len(b))]
    while open_parts:
        low_a, high_a, low_b, high_b = open_parts.pop()
        while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
            found.append((low_a, low_b))
            low_a, low_b = low_a + 1, low_b + 1
        while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
            high_a, high_b = high_a - 1, high_b - 1
            found.append((high_a, high_b))
        if low_a == high_a or low_b == high_b:
            continue
        at_a, low = low_a, low_b
        for i, j in [*_unique_run(a, b, low_a, high_a, low_b, high_b), (high_a, high_b)]:
            # The unique lines themselves are found as ends of the parts around them.
            if i < high_a or (at_a, low) != (low_a, low_b):
                open_parts.append((at_a, i, low, j))
            if i < high_a:
                found.append((i, j))
                at_a, low = i + 1, j + 1
    return sorted(found)


def _unique_run(a: list, b: list, low_a: int, high_a: int, low_b: int, high_b: int) -> list[tuple[int, int]]:
    """Longest rising run of the lines that both parts have once."""
    in_a, in_b = Counter(a[low_a:high_a]), Counter(b[low_b:high_b])
    place = {line: j for j, line in enumerate(b[low_b:high_b], low_b) if in_b[line] == 1}
    both = [(i, place[line]) for i, line in enumerate(a[low_a:high_a], low_a) if in_a[line] == 1 and line in place]
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(both)
    for k, (_, j) in enumerate(both):
        pile = bisect_left(tops, j)
        before[k] = ends[pile - 1] if pile else -1
        tops[pile : pile + 1], ends[pile : pile + 1] = [j], [k]
    run, k = [], ends[-1] if ends else -1
    while k >= 0:
        run.append(both[k])
        k = before[k]
    return run[::-1]


def _split(data: np.ndarray, low: int, high: int) -> list[bytes]:
    return data[low:high].tobytes().split(b"\n") if high > low else []


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for row, data, starts in block_rows(batches):
        split = [[line.strip() for line in _split(data, a, b)] for a, b in zip(starts[:-1], starts[1:])]
        hashes = [[xxhash.xxh64_intdigest(line) - (1 << 63) for line in lines] for lines in split]
        words = [[len(line.split()) for line in lines] for lines in split]
        anchors = [_anchors(*document) for document in zip(hashes, words)]
        nodes = (row["block"].as_py() << ROW_BITS) + np.arange(len(split))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(nodes, pa.int64()),
                pa.array(row["ids"].as_py(), pa.int64()),
                pa.array(hashes, pa.list_(pa.int64())),
                pa.array(words, pa.list_(pa.int32())),
                pa.array(anchors, pa.list_(pa.int64())),
            ],
            ["node", "id", "lines", "words", "anchors"],
        )


def _anchors(lines: list[int], words: list[int]) -> list[int]:
    """The lines with enough words that the document has once."""
    times = Counter(lines)
    return [line for line, n in zip(lines, words) if n >= LEAST_WORDS and times[line] == 1]


def _cut_texts(row: dict, data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """For each document of a block its lines, how many go, and the text of the others."""
    gone = {g["row"]: set(g["lines"]) for g in row["gone"].as_py() or []}
    for r, (low, high) in enumerate(zip(starts[:-1], starts[1:])):
        lines = _split(data, low, high)
        away = gone.get(r, ())
        yield len(lines), len(away), b"\n".join(line for i, line in enumerate(lines) if i not in away)


def _kept(key: str):
    names = [key, "n_lines", "n_removed", "kept_text", "kept_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, data, starts in block_rows(batches):
            out = [(n, m, t.decode(), hashlib.sha256(t).hexdigest()) for n, m, t in _cut_texts(row, data, starts)]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"].as_py(), pa.int64()), *columns], names)

    return work


def _cut_rows(key: str, text: str, columns: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, data, starts in block_rows(batches):
            cut = [(removed, kept) for _, removed, kept in _cut_texts(row, data, starts)]
            rows = [r for r, (removed, kept) in enumerate(cut) if not removed or kept.split()]
            yield whole_rows(row, [cut[r][1] for r in rows], np.array(rows, dtype=np.int64), key, text, columns)

    return work
