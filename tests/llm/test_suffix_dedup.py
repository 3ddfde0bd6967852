import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from estatelake.llm import suffix_dedup
from estatelake.llm.suffix_dedup import ALONE, difference_cover, remove_repeats


def brute(texts, length):
    data = [t.encode() if t else b"" for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    rows = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        rows.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def run(spark, texts, length):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_bytes string")
    found = remove_repeats(docs.repartition(3), length=length).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found]


@pytest.mark.parametrize("length", [3, 12, 50])
def test_like_brute_force(spark, length):
    draw = random.Random(length)
    parts = ["".join(draw.choice("abé ") for _ in range(draw.randrange(1, 3 * length))) for _ in range(12)]
    texts = ["".join(draw.choice(parts) + draw.choice("xyz") for _ in range(draw.randrange(1, 6))) for _ in range(40)]
    texts += [texts[0], texts[0], None, "", "é", "a" * (4 * length)]
    assert run(spark, texts, length) == brute(texts, length)


def test_empty_table_and_equal_ids(spark):
    assert run(spark, [], 5) == []
    docs = spark.createDataFrame([(1, "abcdefg"), (1, "abcdefg"), (None, "other")], "doc_id long, text string")
    found = remove_repeats(docs, length=5).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 0), (1, 7), (1, 7)]


@pytest.mark.parametrize("length", [2, 10, 100, 400])
def test_cover_has_all_differences(length):
    period, residues = difference_cover(length)
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))
    assert period <= length


def test_blocks_are_small(spark, monkeypatch):
    written = []
    write = suffix_dedup.write_blocks

    def kept(*args, **more):
        written.append(write(*args, **more))
        return written[-1]

    monkeypatch.setattr(suffix_dedup, "write_blocks", kept)
    docs = spark.range(0, 12, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 1 << 14).alias("text"))
    found = remove_repeats(docs).collect()
    assert [r.n_removed for r in found] == [1 << 20] * 12
    sizes = [r.n for r in written[0].frame().select(F.octet_length("text").alias("n")).collect()]
    assert sum(sizes) == 12 << 20 and max(sizes) <= 4 << 20


def test_few_ties_take_little_memory():
    """Of a block of 3 MB with some repeats, the tied suffixes cost a few arrays of the ties, none of all its bytes."""
    length, cover = 400, difference_cover(400)
    draw = np.random.default_rng(6)
    data = draw.integers(0, 256, 3 << 20, dtype=np.uint8)
    starts = np.arange(0, len(data) + 1, 1 << 12)
    states = np.full(len(starts) - 1, ALONE, dtype=np.uint8)
    at = suffix_dedup._samples(starts, states, length, cover)
    flags = np.zeros(len(at), dtype=np.uint8)
    flags[draw.choice(len(at), len(at) // 1000, replace=False)] = 1
    row = {"tied": pa.scalar([{"bucket": 0, "reply": flags.tobytes()}])}
    tracemalloc.start()
    found = suffix_dedup._tied_suffixes(row, data, starts, states, length, cover)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    keys, inverse = np.unique(suffix_dedup.Hasher().windows(data, at, at + length - cover[0] + 1), return_inverse=True)
    ranked = at[flags[inverse] > 0]
    expected = {
        s for r in ranked for s in range(max(r - cover[0] + 1, r & -(1 << 12)), min(r, (r & -(1 << 12)) + (1 << 12) - length) + 1)
    }
    assert found.tolist() == sorted(expected)
    assert peak < 20 * len(data)
