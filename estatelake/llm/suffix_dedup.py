"""Exact removal of repeated byte strings by blockwise suffix sorting over a difference cover.

A difference cover is a set of residues modulo its period such that any two
positions, shifted by the same amount less than the period, both fall on it.  So
if the strings of ``length`` bytes at two positions are equal, some pair of cover
samples inside them starts equal windows of ``length - period + 1`` bytes.

1. *Cover ranks.*  Windows at the cover samples (18 of every 307 positions) are
   sorted bucket by bucket; equal windows share a rank, a window that stands
   alone gets none.
2. *Suffix buckets.*  A suffix can tie with another for ``length`` bytes only if a
   ranked sample starts within its first period; all others are settled already and
   never leave their block.  The rest are sorted one bucket at a time by the
   fingerprint of their first ``length`` bytes: a bucket of bounded size is all
   that a task holds.
3. Tied suffixes cover their bytes; the covered runs go.

Equality is all that removal needs, so "sorted" means the order of 64-bit
fingerprints of the strings, not of their bytes.  Of texts that are equal as a
whole only the first takes part in 1 and 2: every string of a copied text occurs twice.

Null texts are empty; documents with equal ids are documents of their own (each
row gives one row); a text shorter than ``length`` keeps everything; an empty
table gives an empty one.  Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.blocks import answered, ask, block_rows, write_blocks
from estatelake.llm.text_arrays import BASES, Hasher
from estatelake.staging import stage

LENGTH = 400
# A task works on arrays of several times a block beside the JVM's heap, so blocks are small.
BLOCK_BYTES = 3 << 20
RESULT = (
    "{key} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>"
)
TEXT_KIND = [("check", "u8"), ("many", "u1")]
# What a whole text is among its equals.
ALONE, FIRST, COPY = 0, 1, 2


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256 and ``removed`` (byte runs)."""
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = write_blocks(docs, key, text, n_bytes, "suffix-blocks", block_bytes=BLOCK_BYTES)
    cover = difference_cover(length)
    equals = ask(blocks.frame(), _whole_texts(length), _first_of_equals, blocks.buckets, TEXT_KIND)
    copies = stage(equals, "copies")
    tied = stage(ask(blocks.with_answers(copies=copies), _cover_windows(length, cover), _repeated, blocks.buckets), "cover-ranks")
    known = blocks.with_answers(copies=copies, tied=tied)
    same = stage(ask(known, _suffixes(length, cover), _repeated, blocks.buckets), "suffix-ties")
    known = blocks.with_answers(copies=copies, tied=tied, same=same)
    return known.mapInArrow(_removed(key, length, cover), RESULT.format(key=key))


def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """Period and residues: a perfect difference set with a period of at most 4/5 of ``length``.

    For a prime q there are q + 1 residues modulo q*q + q + 1 whose differences
    are all different (a line of the projective plane over q elements).
    """
    primes = [q for q in range(2, 200) if all(q % p for p in range(2, q))]
    fitting = [q for q in primes if q * q + q + 1 <= length * 4 // 5]
    if not fitting:
        return 1, np.zeros(1, dtype=np.int64)
    return _line(fitting[-1])


def _line(q: int) -> tuple[int, np.ndarray]:
    """Exponents i where the power i of a generator of the field of q**3 has no x**2 part."""
    period = q * q + q + 1
    order = q**3 - 1
    factors = [p for p in range(2, order) if order % p == 0 and all(p % r for r in range(2, int(p**0.5) + 1))]

    def times(a, b, c):
        full = [0] * 5
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                full[i + j] += x * y
        for i in (4, 3):  # x**3 = c[0] + c[1] x + c[2] x**2
            for j in range(3):
                full[i - 3 + j] += full[i] * c[j]
        return tuple(v % q for v in full[:3])

    def power(n, c):
        result, square = (1, 0, 0), (0, 1, 0)
        while n:
            if n & 1:
                result = times(result, square, c)
            square, n = times(square, square, c), n >> 1
        return result

    one = (1, 0, 0)
    c = next(
        c
        for c in ((a, b, d) for d in range(q) for b in range(q) for a in range(1, q))
        if all((v**3 - c[2] * v * v - c[1] * v - c[0]) % q for v in range(q))
        and power(order, c) == one
        and all(power(order // p, c) != one for p in factors)
    )
    residues, value = [], one
    for i in range(period):
        if value[2] == 0:
            residues.append(i)
        value = times(value, (0, 1, 0), c)
    return period, np.array(residues, dtype=np.int64)



def _whole_texts(length):
    def question(row, data, starts):
        keys, checks, rows = _texts(data, starts, length)
        keys, first, n = np.unique(keys, return_index=True, return_counts=True)
        given = np.zeros(len(keys), dtype=TEXT_KIND)
        given["check"], given["many"] = checks[first], n > 1
        return keys, given

    return question


def _texts(data, starts, length):
    """Two hashes of every text of full length, and which rows these are."""
    rows = np.flatnonzero(np.diff(starts) >= length)
    begin, end = starts[rows], starts[rows + 1]
    return Hasher(BASES[0]).windows(data, begin, end), Hasher(BASES[1]).windows(data, begin, end), rows


def _first_of_equals(keys, given):
    """ALONE; with copies, FIRST in the first block that has the text and COPY in the others."""
    block = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    every, info = np.concatenate(keys), np.concatenate(given)
    order = np.lexsort((block, info["check"], every))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (every[order][1:] != every[order][:-1]) | (info["check"][order][1:] != info["check"][order][:-1])
    group = np.cumsum(new) - 1
    several = np.bincount(group, weights=1 + info["many"][order]) > 1
    state = np.empty(len(order), dtype=np.uint8)
    state[order] = np.where(several[group], np.where(new, FIRST, COPY), ALONE)
    return np.split(state, np.cumsum([len(k) for k in keys])[:-1])


def _text_states(row, data, starts, length):
    """State of each row of the block; of equal texts within the block the first keeps FIRST."""
    keys, _, rows = _texts(data, starts, length)
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    found = answered(row["copies"], np.uint8)[inverse] if len(distinct) else np.zeros(0, dtype=np.uint8)
    again = first[inverse] != np.arange(len(keys)) if len(distinct) else np.zeros(0, dtype=bool)
    states = np.zeros(len(starts) - 1, dtype=np.uint8)
    states[rows] = np.where((found != ALONE) & again, COPY, found)
    return states


def _samples(starts, states, length, cover):
    """Positions of the cover samples with a full window, in documents that take part."""
    period, residues = cover
    window = length - period + 1
    found = []
    for row in np.flatnonzero((np.diff(starts) >= length) & (states != COPY)):
        low, high = starts[row], starts[row + 1] - window
        grid = (np.arange(low, high + 1, period)[:, None] + residues).ravel()
        found.append(grid[grid <= high])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def _distinct(hashes):
    keys, n = np.unique(hashes, return_counts=True)
    return keys, (n > 1).astype(np.uint8)


def _repeated(keys, given):
    """1 for every key that occurs more than once, in another block or in its own."""
    every = np.concatenate(keys)
    _, inverse = np.unique(every, return_inverse=True)
    often = np.bincount(inverse, weights=1 + np.concatenate(given)) > 1
    return np.split(often[inverse].astype(np.uint8), np.cumsum([len(k) for k in keys])[:-1])


def _cover_windows(length, cover):
    window = length - cover[0] + 1

    def question(row, data, starts):
        at = _samples(starts, _text_states(row, data, starts, length), length, cover)
        return _distinct(Hasher().windows(data, at, at + window))

    return question


def _tied_suffixes(row, data, starts, states, length, cover):
    """Starts of all full-length strings that hold a ranked cover sample in their first period."""
    period = cover[0]
    at = _samples(starts, states, length, cover)
    keys, inverse = np.unique(Hasher().windows(data, at, at + length - period + 1), return_inverse=True)
    ranked = at[answered(row["tied"], np.uint8)[inverse] > 0] if len(keys) else at
    return _starts_before(ranked, starts, length, period)


def _starts_before(ranked, starts, length, period):
    """All starts of full-length strings at most ``period`` - 1 bytes before one of ``ranked``, which rises."""
    row = np.searchsorted(starts, ranked, side="right") - 1
    last = np.minimum(ranked, starts[row + 1] - length)
    first = np.maximum(ranked - period + 1, starts[row])
    first[1:] = np.maximum(first[1:], last[:-1] + 1)
    n = np.maximum(last - first + 1, 0)
    found = np.repeat(first - (np.cumsum(n) - n), n)
    found += np.arange(len(found))
    return found


def _suffixes(length, cover):
    def question(row, data, starts):
        states = _text_states(row, data, starts, length)
        at = _tied_suffixes(row, data, starts, states, length, cover)
        return _distinct(Hasher(BASES[1]).windows(data, at, at + length))

    return question


def _removed(key, length, cover):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, data, starts in block_rows(batches):
            states = _text_states(row, data, starts, length)
            at = _tied_suffixes(row, data, starts, states, length, cover)
            keys, inverse = np.unique(Hasher(BASES[1]).windows(data, at, at + length), return_inverse=True)
            twice = at[answered(row["same"], np.uint8)[inverse] > 0] if len(keys) else at
            steps = np.zeros(len(data) + 1, dtype=np.int32)
            steps[twice] += 1
            steps[twice + length] -= 1
            gone = np.cumsum(steps, out=steps)[:-1] > 0
            for r in np.flatnonzero(states != ALONE):
                gone[starts[r] : starts[r + 1]] = True
            yield _result(key, row["ids"], data, starts, gone)

    return work


def _result(key, ids, data, starts, gone):
    columns = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "removed": []}
    for low, high in zip(starts[:-1], starts[1:]):
        away = gone[low:high]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], away, [0]]).astype(np.int8)))
        columns["n_bytes"].append(int(high - low))
        columns["n_removed"].append(int(np.count_nonzero(away)))
        columns["n_spans"].append(len(edges) // 2)
        columns["kept_sha256"].append(hashlib.sha256(data[low:high][~away].tobytes()).hexdigest())
        columns["removed"].append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
    arrays = [pa.array(v, k) for v, k in zip(columns.values(), kinds)]
    return pa.RecordBatch.from_arrays([pa.array(ids.as_py(), pa.int64()), *arrays], [key, *columns])
