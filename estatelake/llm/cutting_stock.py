"""Packing of tokenised documents into fixed sequences by cutting-stock column generation.

A document is cut into whole sequences and one rest.  The histogram of the rests
by length (in units of ``UNIT`` tokens, so bounded whatever the corpus) is all that
reaches the driver.  There a linear program chooses how often to use each pattern,
a multiset of lengths that fits a sequence: starting from patterns filled by falling length, a
knapsack by dynamic programming finds the pattern of most dual value until none
is worth more than its sequence.  Rounded down, the patterns take most documents;
what is left is placed first-fit by falling length.  Spark ranks the pieces of
each length, and a rank says which copy of which pattern a piece belongs to.

Texts are split at ASCII white space before they are tokenised, word by word with
a bounded cache: the tokenizer's own pattern never crosses white space, so the ids are
those of the whole text.  Null and empty texts have only the closing id.  Rows with
the same key are packed each for itself.  An empty table gives an empty one.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.text_arrays import byte_texts, slices
from estatelake.staging import stage

SEQUENCE = 2048
UNIT = 8
CLOSING_ID = 1
# Distinct parts of words whose ids a task remembers; beyond that it starts anew.
CACHED_WORDS = 1 << 19
# UTF-8 bytes of the letters a-z, ß-ö and ø-ÿ, and of no other characters.
LETTER_BYTES = np.zeros(256, dtype=bool)
LETTER_BYTES[[*range(ord("a"), ord("z") + 1), 0xC3, *range(0x9F, 0xB7), *range(0xB8, 0xC0)]] = True
PUNCTUATION = ".,!?;:|#$%&*()-"
# Text bytes that are split into words at once.
SLICE_BYTES = 4 << 20
# The linear program is solved when no more than this share of the sequences can be gained.
TOLERANCE = 1e-3
STEPS_PER_SIZE = 6
# Pieces of one length that one task ranks.
RANKED_TOGETHER = 1 << 17
PIECES = "{key} long, start long, length long, ids_crc32 long, doc_tokens long"


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """Rows (key, start, length, ids_crc32, doc_tokens, sequence_id, offset), one for each piece."""
    pieces = stage(tokenised_pieces(docs, vocabulary, key, text, sequence), "pieces")
    units = F.ceil(F.col("length") / UNIT).cast("int")
    pieces = pieces.withColumn("units", units)
    histogram = dict(pieces.groupBy("units").count().collect())
    slots = assign_slots(histogram, patterns(histogram, -(-sequence // UNIT)))
    ranked = _ranked(pieces, sum(histogram.values()), [key, "start", "ids_crc32", "length"])
    placed = ranked.mapInArrow(_place(slots, key), f"{PIECES.format(key=key)}, sequence_id long")
    order = [F.desc("length"), key, "start", "ids_crc32"]
    before = Window.partitionBy("sequence_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def tokenised_pieces(docs: DataFrame, vocabulary: str, key: str, text: str, sequence: int) -> DataFrame:
    """Every document cut into pieces of at most a sequence; ``vocabulary`` is a tokenizer file."""
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    return rows.mapInArrow(_cut(shared, sequence, key), PIECES.format(key=key))


class WordIds:
    """Ids of texts as unsigned 32-bit numbers, through a cache of parts of words.

    The distinct words of a batch are cut into plain letters and the punctuation after them, the
    distinct parts are looked up, and the ids of all words gathered by place.  Letters and
    punctuation are pieces of their own in the tokenizer's pattern; a word of any other kind is one part.
    Many parts of plain letters are encoded in one call; the ids that end a word say where the
    next begins.  All other parts are encoded one by one.
    """

    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence as Normalizers
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit
        from tokenizers.pre_tokenizers import Sequence as Splits

        self._tokenizer = Tokenizer.from_str(description)
        # Plain letters are composed and in lower case already, and only white space parts them.
        self._letters = Tokenizer(self._tokenizer.model)
        self._letters.normalizer = Normalizers([])
        self._letters.pre_tokenizer = Splits([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._ids = np.zeros(0, dtype="<u4")
        self._starts = np.zeros(1, dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the closing id after it, and the n + 1 starts."""
        # Lower case is part of the tokenizer; its special tokens are found before that.
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(lower))
        words = split.values.dictionary_encode()
        ids, starts = self._of_words(words.dictionary)
        closed = np.append(ids, np.array([CLOSING_ID], dtype="<u4"))
        table = _runs(closed, np.append(starts, len(closed)))
        ends = split.offsets.to_numpy()[1:]
        order = np.insert(words.indices.to_numpy(), ends, len(words.dictionary))
        data, starts = byte_texts(table.take(pa.array(order)))
        return data.view("<u4"), starts[np.concatenate([[0], ends + np.arange(1, len(texts) + 1)])] // 4

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and the n + 1 starts."""
        data, starts = byte_texts(words)
        ends = starts[:-1] + pc.binary_length(pc.utf8_rtrim(words, characters=PUNCTUATION)).to_numpy()
        cuts = np.empty(2 * len(words) + 1, dtype=np.int64)
        cuts[::2] = starts
        cuts[1::2] = np.where(_plain(data, starts[:-1], ends), ends, starts[1:])
        parts = pa.Array.from_buffers(pa.large_string(), 2 * len(words), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        slots = self._slots_of(parts.dictionary)[parts.indices.to_numpy()]
        data, starts = byte_texts(_runs(self._ids, self._starts).take(pa.array(slots)))
        return data.view("<u4"), starts[::2] // 4

    def _slots_of(self, parts: pa.Array) -> np.ndarray:
        if len(self._slots) > CACHED_WORDS:
            self._forget()
        names = parts.to_numpy(zero_copy_only=False).tolist()
        slots = np.array([self._slots.get(name, -1) for name in names], dtype=np.int64)
        data, starts = byte_texts(parts)
        plain = _plain(data, starts[:-1], starts[1:])
        for kind, learn in ((plain, self._learn_letters), (~plain, self._learn)):
            missing = np.flatnonzero((slots < 0) & kind)
            fresh = [names[i] for i in missing.tolist()]
            slots[missing] = range(len(self._slots), len(self._slots) + len(fresh))
            self._slots.update(zip(fresh, slots[missing].tolist()))
            learned = [learn(fresh[low : low + 4096]) for low in range(0, len(fresh), 4096)]
            self._ids = np.concatenate([self._ids, *(ids for ids, _ in learned)])
            sizes = np.concatenate([np.zeros(0, dtype=np.int64), *(sizes for _, sizes in learned)])
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
        return slots

    def _learn_letters(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._letters.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids
        ids = np.array(ids, dtype="<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(parts) else self._learn(parts)

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [found.ids for found in self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.array([i for ids in coded for i in ids], dtype="<u4"), np.array([len(ids) for ids in coded])


def _plain(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of data[begin:end] are plain letters, one or more."""
    others = np.concatenate([[0], np.cumsum(~LETTER_BYTES[data])])
    return (end > begin) & (others[begin] == others[end])


def _runs(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of ids as binary values."""
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(4 * starts), pa.py_buffer(ids)])


def _cut(shared, sequence: int, key: str):
    names = [key, "start", "length", "ids_crc32", "doc_tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(shared.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for first, last in slices(byte_texts(texts)[1], SLICE_BYTES):
                ids, starts = words.encode(texts[first:last])
                out: list[tuple] = []
                for doc, low, high in zip(batch.column(0)[first:last].to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                    for at in range(low, high, sequence):
                        piece = ids[at : min(at + sequence, high)]
                        out.append((doc, at - low, len(piece), zlib.crc32(piece), high - low))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return work


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (units: pieces of that many units) and how often each is used; all pieces are covered."""
    alone = [({u: 1}, n) for u, n in sorted(histogram.items()) if u >= capacity]
    demand = {u: n for u, n in sorted(histogram.items()) if u < capacity}
    if not demand:
        return alone
    sizes = np.array(list(demand), dtype=np.int64)
    left = np.array(list(demand.values()), dtype=np.int64)
    chosen = []
    columns, amounts = column_generation(sizes, left.astype(float), capacity)
    for column, amount in zip(columns.T, amounts):
        used = np.flatnonzero(column)
        times = min(int(amount + 1e-7), *(int(left[i] // column[i]) for i in used)) if len(used) else 0
        if times > 0:
            left -= column.astype(np.int64) * times
            chosen.append(({int(sizes[i]): int(column[i]) for i in used}, times))
    return alone + chosen + [(p, 1) for p in first_fit(sizes, left, capacity)]


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Basis patterns (as columns) and their amounts that meet ``demand`` with few sequences.

    The duals divided by the most valuable pattern's value are feasible, so each step gives a lower
    bound.  The program ends when no more than ``TOLERANCE`` of the sequences, or half of one,
    can be gained, and after ``STEPS_PER_SIZE`` steps for each size; any basis is a valid packing.

    Products are sums over arrays and the inverse is renewed by elimination: after the driver
    has forked for its JVM, threaded linear algebra may wait for threads that are gone.
    """
    basis, amounts = filled_greedily(sizes, demand, capacity)
    inverse = inverted(basis)
    bound = 0.0
    for step in range(STEPS_PER_SIZE * len(sizes)):
        if step % 200 == 199:  # rounding errors of the updates
            inverse = inverted(basis)
            amounts = (inverse * demand).sum(axis=1)
        duals = inverse.sum(axis=0)
        column = best_pattern(sizes, duals, capacity)
        value, used = (duals * column).sum(), amounts.sum()
        bound = max(bound, used / value)
        if value <= 1 + TOLERANCE or used - bound <= max(0.5, TOLERANCE * used):
            break
        direction = (inverse * column).sum(axis=1)
        able = direction > 1e-9
        if not able.any():
            break
        ratios = np.where(able, np.maximum(amounts, 0) / np.where(able, direction, 1), np.inf)
        leaving = int(np.argmin(ratios))
        amounts = amounts - ratios[leaving] * direction
        amounts[leaving] = ratios[leaving]
        basis[:, leaving] = column
        row = inverse[leaving] / direction[leaving]
        inverse -= direction[:, None] * row
        inverse[leaving] = row
    return basis, amounts


def filled_greedily(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A first basis: patterns filled by falling length, each used until one of its lengths is met.

    No later pattern has that length, so the basis is triangular.
    """
    left = demand.astype(float)
    columns, amounts = np.zeros((len(sizes), len(sizes))), np.zeros(len(sizes))
    open_rows = list(range(len(sizes)))[::-1]
    while open_rows:
        room, column = capacity, np.zeros(len(sizes))
        for i in open_rows:
            column[i] = room // sizes[i]
            room -= int(column[i] * sizes[i])
        used = np.flatnonzero(column)
        times = (left[used] / column[used]).min()
        met = used[np.argmin(left[used] / column[used])]
        left[used] = np.maximum(left[used] - column[used] * times, 0)
        columns[:, met], amounts[met] = column, times
        open_rows.remove(met)
    return columns, amounts


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse, by elimination with the largest pivot of each column."""
    n = len(matrix)
    work = np.concatenate([matrix, np.eye(n)], axis=1)
    for k in range(n):
        pivot = k + int(np.argmax(np.abs(work[k:, k])))
        work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        factors = work[:, k].copy()
        factors[k] = 0
        work -= factors[:, None] * work[k]
    return work[:, n:]


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of sizes within ``capacity`` of most value: an unbounded knapsack."""
    places = np.flatnonzero(values > 1e-12)
    items, gains = sizes[places], values[places]
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fitting = np.searchsorted(items, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fitting[room]:
            total = best[room - items[: fitting[room]]] + gains[: fitting[room]]
            top = total.argmax()
            if total[top] > best[room]:
                best[room], choice[room] = total[top], top
    column = np.zeros(len(sizes))
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            column[places[choice[room]]] += 1
            room -= items[choice[room]]
    return column


def first_fit(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """Sequences for the rest of the pieces, longest first, each filled with the longest that still fit."""
    left = {int(s): int(n) for s, n in zip(sizes[::-1], counts[::-1]) if n > 0}
    found = []
    while left:
        room, used = capacity, {}
        for size in list(left):
            n = min(left[size], room // size)
            if n:
                used[size] = n
                room -= n * size
                left[size] -= n
                if not left[size]:
                    del left[size]
        found.append(used)
    return found


def assign_slots(histogram: dict[int, int], chosen: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By units: first rank, first sequence and pieces per sequence of every use of a pattern."""
    slots: dict[int, list[tuple[int, int, int]]] = {u: [] for u in histogram}
    taken = dict.fromkeys(histogram, 0)
    sequence = 0
    for pattern, times in chosen:
        for units, per in pattern.items():
            slots[units].append((taken[units], sequence, per))
            taken[units] += per * times
        sequence += times
    assert taken == histogram
    return {u: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for u, rows in slots.items()}


def _ranked(pieces: DataFrame, n: int, order: list[str]) -> DataFrame:
    """``rank`` from 0 among the pieces of equal units.

    Pieces of one length, which may be a large part of all, are ranked in shares.
    """
    shares = 16 + n // RANKED_TOGETHER
    dealt = pieces.withColumn("share", F.pmod(F.xxhash64(*order), F.lit(shares)))
    counts = dealt.groupBy("units", "share").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("units").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("units", "share", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("units", "share").orderBy(*order)
    ranked = dealt.withColumn("within", F.row_number().over(within) - 1).join(starts, ["units", "share"])
    return ranked.withColumn("rank", F.col("before") + F.col("within"))


def _place(slots: dict[int, tuple[np.ndarray, ...]], key: str):
    names = [key, "start", "length", "ids_crc32", "doc_tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, rank = batch.column("units").to_numpy(), batch.column("rank").to_numpy()
            sequence = np.empty(len(units), dtype=np.int64)
            for u in np.unique(units):
                mine = np.flatnonzero(units == u)
                first, base, per = slots[int(u)]
                slot = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine] = base[slot] + (rank[mine] - first[slot]) // per[slot]
            columns = [batch.column(n) for n in names] + [pa.array(sequence)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id"])

    return work
