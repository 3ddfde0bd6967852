"""Documents packed into blocks of a few megabytes, and questions about all blocks.

Some questions need a look at a value from everywhere ("does this window occur
anywhere else?", "how often is this word used?").  Asked row by row they shuffle
every occurrence.  Here each block sends its *distinct* keys, sorted, one binary
per bucket of the key space; a bucket answers every block in the order of its
keys.  So a key that a third of the corpus holds costs one entry per block, no
group grows with the number of occurrences, and no positions travel at all.

The blocks are a table bucketed by block number: answers come to the texts, the
texts are never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.text_arrays import byte_texts, slices
from estatelake.staging import staging_path

BLOCK_BYTES = 8 << 20
# A document's number is that of its block, shifted, and its place in the block.
ROW_BITS = 18
# Text bytes for each bucket of the key space.
BUCKET_BYTES = 4 << 20
# Blocks for each folder bucket of the written table.
BLOCKS_PER_TASK = 2
SCHEMA = "block long, ids array<long>, sizes array<int>, text binary, rest {rest}"


class Blocks:
    """The written blocks of a corpus; ``buckets`` follows its size."""

    def __init__(self, table: str, spark, text_bytes: int, tasks: int):
        self._table, self._spark, self.text_bytes, self.tasks = table, spark, text_bytes, tasks
        self.buckets = max(32, -(-text_bytes // BUCKET_BYTES))

    def frame(self) -> DataFrame:
        return self._spark.table(self._table)

    def with_answers(self, **answers: DataFrame) -> DataFrame:
        """Blocks beside what the buckets answered, a list of (bucket, reply) for each name."""
        frame = self.frame()
        for name, answer in answers.items():
            listed = answer.groupBy("block").agg(F.collect_list(F.struct("bucket", "reply")).alias(name))
            frame = frame.join(listed, "block", "left")
        return frame


def write_blocks(
    docs: DataFrame, key: str, text: str, text_bytes: int, label: str, carry: Sequence[str] = (), block_bytes: int = BLOCK_BYTES
) -> Blocks:
    """Packs documents as they are read; ``text_bytes`` is the size of all texts, ``block_bytes`` that of a block.

    The columns to ``carry`` come along as ``rest``, one struct for each document, beside whether
    its text is null, so whole rows can be given back (see ``whole_rows``).
    """
    spark = docs.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    rest = "".join(f", `{name}`: {kinds[name]}" for name in carry)
    schema = SCHEMA.format(rest=f"array<struct<no_text__: boolean{rest}>>" if carry else "array<boolean>")
    packed = docs.select(
        F.col(key).cast("long").alias("id"), F.col(text).alias("text"), *[F.col(f"`{name}`") for name in carry]
    ).mapInArrow(_pack(list(carry), block_bytes), schema)
    tasks = max(4, -(-text_bytes // (BLOCK_BYTES * BLOCKS_PER_TASK)))
    table = f"blocks_{uuid.uuid4().hex}"
    (
        packed.write.bucketBy(tasks, "block")
        .option("path", staging_path(spark, label))
        .option("compression", "zstd")
        .saveAsTable(table)
    )
    return Blocks(table, spark, text_bytes, tasks)


def _pack(carry: list[str], block_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 20
        for batch in batches:
            data, starts = byte_texts(batch.column(1))
            rest = pc.is_null(batch.column(1))
            if carry:
                rest = pa.StructArray.from_arrays([rest, *batch.columns[2:]], ["no_text__", *carry])
            for first, last in slices(starts, block_bytes):
                block += 1
                ends = pa.array([0, last - first], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([batch.column(0)[first:last].to_pylist()], pa.list_(pa.int64())),
                        pa.array([np.diff(starts[first : last + 1])], pa.list_(pa.int32())),
                        pa.array([data[starts[first] : starts[last]].tobytes()], pa.binary()),
                        pa.ListArray.from_arrays(ends, rest[first:last]),
                    ],
                    ["block", "ids", "sizes", "text", "rest"],
                )

    return work


def whole_rows(row: dict, texts: list[bytes], rows: np.ndarray, key: str, text: str, columns: list[str]) -> pa.RecordBatch:
    """The ``rows`` of a block as they were, with ``texts`` (one for each) as their text."""
    rest = row["rest"].values.take(pa.array(rows))
    ids = row["ids"].values.take(pa.array(rows))
    nulls = rest.field("no_text__").to_pylist()
    shown = pa.array([None if n else t.decode() for n, t in zip(nulls, texts)], pa.string())
    kept = {key: ids, text: shown}
    return pa.RecordBatch.from_arrays([kept[c] if c in kept else rest.field(c) for c in columns], columns)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Each block as its row, the text bytes and the starts of its documents."""
    for batch in batches:
        for row in range(batch.num_rows):
            sizes = batch.column("sizes")[row].values.to_numpy()
            starts = np.zeros(len(sizes) + 1, dtype=np.int64)
            np.cumsum(sizes, out=starts[1:])
            data = np.frombuffer(batch.column("text")[row].as_buffer(), dtype=np.uint8)
            yield {n: batch.column(n)[row] for n in batch.schema.names if n not in ("sizes", "text")}, data, starts


def ask(
    frame: DataFrame,
    question: Callable[[dict, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    answer: Callable[[list[np.ndarray], list[np.ndarray]], list[np.ndarray]],
    buckets: int,
    given_kind=np.uint8,
) -> DataFrame:
    """Rows (block, bucket, reply): for each block the bucket's values in the order of its keys.

    ``question`` gives the sorted distinct keys of a block and a value
    of ``given_kind`` for each; ``answer`` gets the lists of one bucket and returns as many lists of values.
    """

    def send(batches):
        for row, data, starts in block_rows(batches):
            keys, values = question(row, data, starts)
            edges = np.append(np.searchsorted(keys, lower_edges(buckets)), len(keys))
            full = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(full), row["block"].as_py()), pa.int64()),
                    pa.array(full, pa.int32()),
                    pa.array([keys[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()),
                    pa.array([values[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()),
                ],
                ["block", "bucket", "keys", "given"],
            )

    def reply(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block", ignore_index=True)
        keys = [np.frombuffer(k, dtype=np.uint64) for k in rows["keys"]]
        given = [np.frombuffer(v, dtype=given_kind) for v in rows["given"]]
        return pd.DataFrame(
            {"block": rows["block"], "bucket": rows["bucket"], "reply": [r.tobytes() for r in answer(keys, given)]}
        )

    sent = frame.mapInArrow(send, "block long, bucket int, keys binary, given binary")
    return sent.groupBy("bucket").applyInPandas(reply, "block long, bucket int, reply binary")


def lower_edges(buckets: int) -> np.ndarray:
    """Lower ends of equal ranges of the 64-bit keys."""
    return np.array([(b << 64) // buckets for b in range(buckets)], dtype=np.uint64)


def answered(replies, kind) -> np.ndarray:
    """The values for all keys of a block, in the order of its keys."""
    rows = replies.as_py() or []
    rows.sort(key=lambda r: r["bucket"])
    return np.frombuffer(b"".join(r["reply"] for r in rows), dtype=kind)
