"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, lower-cased, each with the bytes that all its
occurrences take as its weight.  Every sample draws for each term two gamma values r, c and
a shift b from the term's hash alone; with weight S

    t = floor(ln S / r + b),   ln y = r (t - b),   ln a = ln c - ln y - r

and the term of least ln a, together with its t, is the sample.  Two texts agree on
a sample with a probability that is the generalised Jaccard similarity of their
weights, sum of minima over sum of maxima.  A fingerprint keeps 8 bits of each of
128 samples; chance agreement of these is taken off the likeness.

Every text is also compared with its edited text (its last half replaced by as many
characters from the start of the next text) and with the next text, by ascending key; after
the last comes the first.  Texts are dealt by ranges of the key once; each range sees its
rows in order, and the last of a range meets the first of the next afterwards.

Null texts are empty.  A text without words has the empty fingerprint, which is
like another empty one (1) and like no other (0).  Rows with equal keys follow each
other by a hash of the text; null keys come first.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.text_arrays import Hasher, finish
from estatelake.staging import stage

SAMPLES = 128
LEVELS = 256
# Text bytes for each range of keys, and those fingerprinted at once.
RANGE_BYTES = 8 << 20
BATCH_BYTES = 4 << 20
NORMAL, FIRST, LAST = 0, 1, 2
ROW = (
    "kind int, part int, {key} long, n_chars long, edited_sha binary, own binary, edited binary, "
    "near_edited double, near_next double, text string"
)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = max(8, -(-n_bytes // RANGE_BYTES))
    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce(text, F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(ranges, key).sortWithinPartitions(key, F.xxhash64("text"))
    found = stage(dealt.mapInArrow(_range(key), ROW.format(key=key)), "fingerprints")
    ends = _range_ends(found, key).mapInArrow(_pairs(key), ROW.format(key=key))
    return (
        found.where(F.col("kind") == NORMAL)
        .union(ends)
        .select(
            key,
            "n_chars",
            F.lower(F.hex("edited_sha")).alias("edited_sha256"),
            F.lower(F.hex("own")).alias("fingerprint"),
            F.lower(F.hex("edited")).alias("edited_fingerprint"),
            "near_edited",
            "near_next",
        )
    )


def _range_ends(found: DataFrame, key: str) -> DataFrame:
    """The last row of each range beside the first of the next; there is one row for each range."""
    first = found.where(F.col("kind") == FIRST).select("part", F.col("text").alias("next_text"))
    whole = Window.orderBy("part")
    order = first.select("part", F.lead("part").over(whole).alias("next"), F.min("part").over(Window.partitionBy()).alias("start"))
    order = order.select("part", F.coalesce("next", "start").alias("next"))
    last = found.where(F.col("kind") == LAST).select("part", key, "text")
    following = first.withColumnRenamed("part", "next")
    return last.join(order, "part").join(following, "next").select(key, "text", "next_text")


def term_weights(hasher: Hasher, texts: list[bytes]):
    """Distinct words of all texts: text, hash and weight, by text and hash."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    hashes, begin, end, before = hasher.words(data, np.concatenate([[0], np.cumsum(sizes)]))
    text = np.repeat(np.arange(len(texts)), np.diff(before))
    order = np.lexsort((hashes, text))
    hashes, text, length = hashes[order], text[order], (end - begin)[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    weight = np.add.reduceat(length, first) if len(first) else length
    return text[first], hashes[first], weight


def sample(texts: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_texts: int) -> np.ndarray:
    """One row of ``SAMPLES`` bytes for each text; zeros where a text has no terms."""
    result = np.zeros((n_texts, SAMPLES), dtype=np.uint8)
    if not len(terms):
        return result
    # Draws depend on the term and its weight only; each such pair is drawn once.
    _, one, place = np.unique(finish(terms ^ weights.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
    term, log_weight = terms[one], np.log(weights[one])
    first = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
    for k in range(SAMPLES):
        ranked = _draws(term, log_weight, k)
        result[texts[first], k] = np.minimum.reduceat(ranked[place], first) & np.uint64(LEVELS - 1)
    return result


def _draws(term: np.ndarray, log_weight: np.ndarray, k: int) -> np.ndarray:
    """For each term ln a in the high 32 bits, in their order, and bits of (term, t) in the low ones."""
    one, two, three = (finish(term + np.uint64(0xA24BAED4963EE407 * (3 * k + j + 1) % (1 << 64))) for j in range(3))
    r = -np.log(_uniform(one) * _uniform(one >> np.uint64(32)))
    c = -np.log(_uniform(two) * _uniform(two >> np.uint64(32)))
    shift = _uniform(three)
    t = np.floor(log_weight / r + shift)
    value = (np.log(c) - r * (t - shift) - r).astype(np.float32)
    bits = value.view(np.uint32)
    # Floats as unsigned numbers of the same order.
    bits = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
    token = finish(three + t.astype(np.int64).astype(np.uint64)) >> np.uint64(40)
    return (bits << np.uint64(32)) | token


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) / 4294967296.0


def likeness(a: np.ndarray, b: np.ndarray, a_empty: np.ndarray, b_empty: np.ndarray) -> np.ndarray:
    agree = (a == b).mean(axis=1)
    near = np.maximum(0.0, (agree - 1 / LEVELS) / (1 - 1 / LEVELS))
    return np.where(a_empty | b_empty, (a_empty & b_empty).astype(float), near)


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(hasher: Hasher, keys: list, texts: list[str], following: list[str] | None = None, kind: int = NORMAL):
    """Result columns of all texts that have a next one: the text after each in the list, or ``following``."""
    n = len(texts) - (following is None)
    after = texts[1:] if following is None else following
    edited = [edited_text(t, f).encode() for t, f in zip(texts[:n], after)]
    every = [t.encode() for t in texts] + edited + ([] if following is None else [t.encode() for t in following])
    text, terms, weights = term_weights(hasher, every)
    marks = sample(text, terms, weights, len(every))
    empty = np.bincount(text, minlength=len(every)) == 0
    own, changed = np.arange(n), len(texts) + np.arange(n)
    then = own + 1 if following is None else changed + n
    near = [likeness(marks[own], marks[x], empty[own], empty[x]) for x in (changed, then)]
    binary = [b"" if e else m.tobytes() for m, e in zip(marks, empty)]
    shas = [hashlib.sha256(e).digest() for e in edited]
    values = [
        [NORMAL] * n, [0] * n, keys[:n], [len(t) for t in texts[:n]], shas,
        [binary[i] for i in own], [binary[i] for i in changed], *near, [None] * n,
    ]
    return values


def _batch(key: str, values) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2, pa.string()]
    names = ["kind", "part", key, "n_chars", "edited_sha", "own", "edited", "near_edited", "near_next", "text"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)


def _range(key: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part = Hasher(), TaskContext.get().partitionId()
        keys: list = []
        texts: list[str] = []
        size, seen = 0, False

        def end(kind, k, text):
            return _batch(key, [[kind], [part], [k], *[[None]] * 6, [text]])

        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not seen:
                    yield end(FIRST, k, text)
                    seen = True
                keys.append(k)
                texts.append(text)
                size += len(text)
                if size > BATCH_BYTES and len(texts) > 1:
                    yield _batch(key, _compared(hasher, keys, texts))
                    keys, texts, size = keys[-1:], texts[-1:], len(text)
        if len(texts) > 1:
            yield _batch(key, _compared(hasher, keys, texts))
        if texts:
            yield end(LAST, keys[-1], texts[-1])

    return work


def _pairs(key: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            keys, texts, following = (batch.column(i).to_pylist() for i in range(3))
            for row in zip(keys, texts, following):
                yield _batch(key, _compared(hasher, *([x] for x in row)))

    return work
