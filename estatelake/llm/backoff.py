"""Language-model scores from a weighted backoff automaton of bigrams.

States are the words that continue in training (and the start of a text); an arc
from state h over word w is a bigram that training holds, once or more.  Every
state has a failure arc to the state without context, whose arcs are all words.
Weights are log10 probabilities of

    P(w | h) = max(count(h w) - D, 0) / count(h) + failure(h) * P(w)
    P(w)     = (count(w) + 0.1) / (N + 0.1 * (V + 1))

where ``failure(h)`` is what the arcs of h leave, so each state sums to one over all
words and one unknown word.  A text is read once from left to right: an arc is
taken where there is one, else the failure weight is added and the word is read
without context; then the word is the state.

The model is never in one place.  Each block of documents asks for the weights of
its own distinct words and bigrams (see ``blocks``), so counts, arcs and failure
weights grow with the corpus and a task holds those of one block or one bucket.
Pairs with a word that training does not hold are never asked for.

Training rows are those whose key's crc32 is no multiple of ``held_out_of``.  Null
texts are empty: one token, the end.  Null keys train as the key of the text "".
Without training rows every known count is 0 and scores follow the formula
above with N = V = 0.  An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.blocks import answered, ask, block_rows, write_blocks
from estatelake.llm.text_arrays import Hasher, finish
from estatelake.staging import stage

# A block's tokens, its distinct words and bigrams and the three lists of answers are in memory together.
BLOCK_BYTES = 3 << 20
HELD_OUT_OF = 10
ADDED = 0.1
DISCOUNT = 0.5
# How often training holds a bigram that has an arc, at least.
LEAST_COUNT = 1
# The numbers of the token after a text and of the state before it.
END, START = np.uint64(0x5EED0000E0D), np.uint64(0x5EED00057A7)
RESULT = (
    "{key} long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = write_blocks(docs, key, text, n_bytes, "score-blocks", block_bytes=BLOCK_BYTES)
    words = stage(ask(blocks.frame(), _words, _totals, blocks.buckets, np.uint32), "word-counts")
    total, distinct = _size_of(words)
    known = blocks.with_answers(words=words)
    pairs = stage(ask(known, _pairs, _arcs, blocks.buckets, np.uint32), "arcs")
    known = blocks.with_answers(words=words, pairs=pairs)
    states = stage(ask(known, _arc_mass, _sums, blocks.buckets, np.float64), "states")
    known = blocks.with_answers(words=words, pairs=pairs, states=states)
    return known.mapInArrow(_scores(key, total, distinct), RESULT.format(key=key))


def _size_of(words: DataFrame) -> tuple[int, int]:
    """N and V, as each bucket counted them for the block that it answers first."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies = [np.frombuffer(r.as_buffer(), dtype=WORD_REPLY) for r in batch.column(0)]
            owned = [r["total"][r["owned"] > 0] for r in replies]
            n, v = [int(o.sum()) for o in owned], [int(np.count_nonzero(o)) for o in owned]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(v, pa.int64())], ["n", "v"])

    counted = words.select("reply").mapInArrow(sums, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return counted[0] or 0, counted[1] or 0


# Reply for a word: its count in training, and whether this block is the first that has it.
WORD_REPLY = [("total", "u8"), ("owned", "u1")]
OWNED = np.uint32(1 << 31)


class _Tokens:
    """The token sequence of a block: hashes, a start before and an end after each text."""

    def __init__(self, row, data, starts):
        hashes, _, _, before = Hasher().words(data, starts)
        rows = len(starts) - 1
        size = np.diff(before) + 2
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.sequence = np.empty(self.first[-1], dtype=np.uint64)
        inner = np.ones(len(self.sequence), dtype=bool)
        inner[self.first[:-1]] = inner[self.first[1:] - 1] = False
        self.sequence[self.first[:-1]], self.sequence[self.first[1:] - 1] = START, END
        self.sequence[inner] = hashes
        ids = row["ids"].as_py()
        self.held_out = np.array([zlib.crc32(str("" if i is None else i).encode()) % HELD_OUT_OF == 0 for i in ids], dtype=bool)
        self.trains = np.repeat(~self.held_out, size)
        self.is_start = np.zeros(len(self.sequence), dtype=bool)
        self.is_start[self.first[:-1]] = True
        # Words of the block: ``place`` of each token among its distinct ones.
        self.words, self.place = np.unique(self.sequence, return_inverse=True)
        self.rows = rows

    def pair_positions(self, totals):
        """Tokens whose bigram with the token before may be an arc."""
        often = (totals >= LEAST_COUNT)[self.place]
        often |= self.is_start
        at = np.flatnonzero(often[1:] & often[:-1] & ~self.is_start[1:]) + 1
        return at, finish(self.sequence[at - 1] * np.uint64(3) + self.sequence[at])


def _words(row, data, starts):
    """How often each distinct token is in training texts; a start counts as the texts it opens."""
    tokens = _Tokens(row, data, starts)
    return tokens.words, np.bincount(tokens.place[tokens.trains], minlength=len(tokens.words)).astype(np.uint32)


def _grouped(keys, given):
    every = np.concatenate(keys)
    _, first, inverse = np.unique(every, return_index=True, return_inverse=True)
    totals = np.bincount(inverse, weights=np.concatenate(given).astype(np.float64))
    owned = np.zeros(len(every), dtype=bool)
    owned[first] = True
    return every, totals[inverse], owned, np.cumsum([len(k) for k in keys])[:-1]


def _totals(keys, given):
    every, totals, owned, cuts = _grouped(keys, given)
    reply = np.zeros(len(every), dtype=WORD_REPLY)
    reply["total"], reply["owned"] = totals, owned & (every != START)
    return np.split(reply, cuts)


def _pairs(row, data, starts):
    tokens = _Tokens(row, data, starts)
    at, pairs = tokens.pair_positions(answered(row["words"], WORD_REPLY)["total"])
    keys, place = np.unique(pairs, return_inverse=True)
    return keys, np.bincount(place, weights=tokens.trains[at], minlength=len(keys)).astype(np.uint32)


def _arcs(keys, given):
    """Counts of the bigrams that are arcs, else 0; the top bit names the block that reports the arc."""
    _, totals, owned, cuts = _grouped(keys, given)
    kept = np.where(totals >= LEAST_COUNT, np.minimum(totals, OWNED - 1), 0).astype(np.uint32)
    kept[owned & (kept > 0)] |= OWNED
    return np.split(kept, cuts)


def _arc_mass(row, data, starts):
    """The discounted counts of the arcs that this block reports, summed by state."""
    tokens = _Tokens(row, data, starts)
    totals = answered(row["words"], WORD_REPLY)["total"]
    at, pairs = tokens.pair_positions(totals)
    _, first = np.unique(pairs, return_index=True)
    arcs = answered(row["pairs"], np.uint32)
    own = np.flatnonzero(arcs & OWNED)
    mass = np.zeros(len(tokens.words))
    np.add.at(mass, tokens.place[at[first[own]] - 1], (arcs[own] & ~OWNED) - DISCOUNT)
    states = np.flatnonzero((totals >= LEAST_COUNT) | (tokens.words == START))
    return tokens.words[states], mass[states]


def _sums(keys, given):
    _, totals, _, cuts = _grouped(keys, given)
    return np.split(totals, cuts)


def _scores(key: str, total: int, distinct: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, data, starts in block_rows(batches):
            tokens = _Tokens(row, data, starts)
            counts = answered(row["words"], WORD_REPLY)["total"].astype(np.float64)
            alone = (counts + ADDED) / (total + ADDED * (distinct + 1))
            states = np.flatnonzero((counts >= LEAST_COUNT) | (tokens.words == START))
            mass = np.zeros(len(counts))
            mass[states] = answered(row["states"], np.float64)
            # What a state leaves for its failure arc; a word without arcs leaves all.
            share = 1 / np.maximum(counts, 1)
            failure = 1 - mass * share
            at, pairs = tokens.pair_positions(counts)
            _, place = np.unique(pairs, return_inverse=True)
            arcs = np.zeros(len(tokens.sequence))
            arcs[at] = (answered(row["pairs"], np.uint32) & ~OWNED)[place] if len(at) else 0
            before = np.concatenate([tokens.place[:1], tokens.place[:-1]])
            base = np.log10(alone)[tokens.place]
            taken = np.maximum(arcs - DISCOUNT, 0) * share[before] + failure[before] * alone[tokens.place]
            step = np.log10(taken)
            step[tokens.is_start] = base[tokens.is_start] = 0
            known = (counts > 0)[tokens.place] & ~tokens.is_start
            first = tokens.first[:-1]
            n = tokens.rows
            columns = [
                pa.array(row["ids"].as_py(), pa.int64()),
                pa.array(tokens.held_out, pa.bool_()),
                pa.array(np.diff(tokens.first) - 1, pa.int64()),
                pa.array(np.add.reduceat(known.astype(np.int64), first) if n else [], pa.int64()),
                pa.array(np.full(n, total), pa.int64()),
                pa.array(np.add.reduceat(base, first) if n else [], pa.float64()),
                pa.array(np.add.reduceat(step, first) if n else [], pa.float64()),
            ]
            names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return work
