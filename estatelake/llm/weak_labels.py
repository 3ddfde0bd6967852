"""Text quality from weak labels: heuristics, their accuracies by EM, a hashed linear scorer.

1. *Labellers.*  Simple measures of a text vote good, bad or undecided, and are silent where a text is too short.  They overlap and disagree; no hand-made label is used.
2. *EM.*  How each labeller votes on good documents and on each kind of junk (one for
   each labeller's concern), and how many there are of each, are estimated from the
   number of documents with each pattern of votes.  Spark counts the patterns of all documents; there are at most ``4 ** labellers`` of them.
3. *Scorer.*  The posterior of a document's pattern is its soft label.  A logistic
   model over hashed words and hashed levels of the measures is fitted to a sample of
   about ``SAMPLE`` documents, twice that at most, drawn by a hash of the row.
4. Every document is scored; it is kept from 0.5 on.

A text without words (null, empty, white space) is not kept and has the score of
an empty feature set.  Equal texts have equal scores; rows with equal keys are
documents of their own.  Where all documents vote alike, the sample has one soft label and all
get about that score.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.text_arrays import Hasher, byte_texts, finish, slices
from estatelake.staging import stage

SAMPLE = 8192
HASH_BITS = 18
BATCH_BYTES = 2 << 20
UNDECIDED, GOOD, BAD, SILENT = 0, 1, 2, 3
# Measures of a text: good up to the first limit, bad from the second on, undecided between.
LABELLERS = {
    "signs": (0.01, 0.05),  # signs that are no usual punctuation, of all bytes but space
    "capitals": (0.12, 0.40),  # capitals, of all ASCII letters
    "sameness": (0.45, 0.65),  # 1 - different words of all words
    "favourite": (0.15, 0.30),  # the most frequent word, of all words
    "repeats": (0.10, 0.40),  # lines that the text had before, of all lines
    "bars": (0.02, 0.10),  # words that are a bar, of all words
    "stutter": (0.05, 0.30),  # words equal to the one before, of all words
    "length": (6.5, 8.5),  # bytes of a word, mean
}
# Measures of a few words say little: silent below so many words.
LEAST_WORDS = {"sameness": 20, "favourite": 20, "length": 20, "stutter": 4}
# Labellers are better than chance: usual shares of undecided, good and bad votes on good
# texts, on junk and on junk of the labeller's own kind, and the weight of these beside what is counted.
USUAL_ON_GOOD, USUAL_ON_BAD, USUAL_ON_OWN_KIND, PRIOR = (0.04, 0.95, 0.01), (0.1, 0.5, 0.4), (0.05, 0.05, 0.9), 0.2
LEVELS = 32
ROUNDS, STEPS = 200, 150
PENALTY = 1e-4

_letter = np.zeros(256, dtype=bool)
_letter[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_sign = np.zeros(256, dtype=bool)
_sign[[ord(c) for c in '!#$%&*+/<=>@[\\]^_`{|}~']] = True


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, votes, posterior, score, kept), votes as one digit for each labeller."""
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    posterior, model = fit(docs, key, text)
    schema = f"{key} long, votes string, posterior double, score double, kept boolean"
    return rows.mapInArrow(_scored(key, posterior, model), schema)


def good_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, as they are."""
    _, model = fit(docs, key, text)
    return docs.mapInArrow(_good(text, model), docs.schema)


def fit(docs: DataFrame, key: str, text: str) -> tuple[dict[str, float], tuple[np.ndarray, float]]:
    """Posteriors of all vote patterns of the corpus, and the scorer."""
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    patterns = rows.select("text").mapInArrow(_patterns, "pattern string, n long")
    counted = patterns.groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    posterior = pattern_posteriors({r["pattern"]: r["n"] for r in counted})
    total = sum(r["n"] for r in counted)
    share = int((1 << 40) * min(1.0, SAMPLE / max(total, 1)))
    drawn = rows.where(F.pmod(F.xxhash64(key, "text"), F.lit(1 << 40)) < F.lit(share))
    sample = drawn.select("text").mapInArrow(_features, "pattern string, features binary").limit(2 * SAMPLE).collect()
    model = fit_scorer(
        [np.frombuffer(r["features"], dtype=np.int32) for r in sample],
        np.array([posterior[r["pattern"]] for r in sample]),
    )
    return posterior, model


def pattern_posteriors(counts: dict[str, int]) -> dict[str, float]:
    """Probability that a document with a pattern of votes is good, by expectation-maximisation."""
    if not counts:
        return {}
    names = sorted(counts)
    votes = np.array([[int(v) for v in name] for name in names])
    n = np.array([counts[name] for name in names], dtype=float)
    kinds = votes.shape[1]
    bad = (votes == BAD).astype(float)
    # At first a text with a bad vote is junk of the kinds of its bad votes.
    belief = np.concatenate([np.where(bad.any(axis=1), 0.1, 0.9)[:, None], bad + 0.1 / kinds], axis=1)
    belief[:, 1:] *= ((1 - belief[:, 0]) / belief[:, 1:].sum(axis=1))[:, None]
    usual = np.tile(np.array(USUAL_ON_BAD), (1 + kinds, kinds, 1))
    usual[0] = USUAL_ON_GOOD
    usual[1 + np.arange(kinds), np.arange(kinds)] = USUAL_ON_OWN_KIND
    shown = np.stack([votes == v for v in (UNDECIDED, GOOD, BAD)], axis=-1).astype(float)
    for _ in range(ROUNDS):
        weight = n[:, None] * belief
        share = (weight.sum(axis=0) + 1) / (n.sum() + 1 + kinds)
        # A labeller's votes on each class, beside the usual ones; silence says nothing.
        rates = np.einsum("pc,plv->clv", weight, shown) + (1 + PRIOR * weight.sum(axis=0))[:, None, None] * usual
        rates /= rates.sum(axis=2, keepdims=True)
        logs = np.log(share) + np.einsum("plv,clv->pc", shown, np.log(rates))
        odds = np.exp(logs - logs.max(axis=1, keepdims=True))
        before, belief = belief, odds / odds.sum(axis=1, keepdims=True)
        if np.abs(belief - before).max() < 1e-9:
            break
    return dict(zip(names, belief[:, 0].tolist()))


def fit_scorer(features: list[np.ndarray], soft: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the hashed features and a constant: logistic loss on soft labels, accelerated descent."""
    weights, constant = np.zeros(1 << HASH_BITS), 0.0
    if not features:
        return weights, constant
    index, value, doc = _sparse(features)
    # Steps of 1 / (largest squared norm / 4) never overshoot.
    rate = 4 / (1 + float(np.bincount(doc, weights=value * value).max(initial=0.0)))
    ahead, ahead_constant = weights, constant
    for step in range(STEPS):
        margin = np.bincount(doc, weights=ahead[index] * value, minlength=len(features)) + ahead_constant
        error = (1 / (1 + np.exp(-margin)) - soft) / len(features)
        gradient = np.bincount(index, weights=value * error[doc], minlength=len(weights)) + PENALTY * ahead
        new, new_constant = ahead - rate * gradient, ahead_constant - rate * error.sum()
        speed = step / (step + 3)
        ahead = new + speed * (new - weights)
        ahead_constant = new_constant + speed * (new_constant - constant)
        weights, constant = new, new_constant
    return weights, constant


def _sparse(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, value and row; levels count 1 each, words 1 together in squares."""
    sizes = np.array([len(f) for f in features])
    doc = np.repeat(np.arange(len(features)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    n_words = np.maximum(sizes - len(LABELLERS), 1)
    value = np.where(place < len(LABELLERS), 1.0, 1 / np.sqrt(n_words)[doc])
    return np.concatenate(features).astype(np.int64), value, doc


def measures(hasher: Hasher, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table of the measures, one row for each text, and the number of words."""
    n = len(starts) - 1

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[starts])

    hashes, begin, end, before = hasher.words(data, starts)
    words = np.diff(before)
    text = np.repeat(np.arange(n), words)
    size = end - begin
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    is_bar = (size == 1) & (data[begin] == ord("|")) if len(begin) else same
    solid = np.bincount(text, weights=size, minlength=n)
    capitals, letters = (data >= ord("A")) & (data <= ord("Z")), (data >= ord("a")) & (data <= ord("z"))
    different_words, most = _distinct(text, hashes, n)
    lines, different = _line_counts(hasher, data, starts)
    per_word = np.maximum(words, 1)
    table = {
        "signs": count(_sign[data]) / np.maximum(solid, 1),
        "capitals": count(capitals) / np.maximum(count(capitals | letters), 1),
        "sameness": (words - different_words) / per_word,
        "favourite": most / per_word,
        "repeats": (lines - different) / np.maximum(lines, 1),
        "bars": np.bincount(text, weights=is_bar, minlength=n) / per_word,
        "stutter": np.bincount(text, weights=same, minlength=n) / per_word,
        "length": solid / per_word,
    }
    return np.stack([table[name] for name in LABELLERS], axis=1), words


def _distinct(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many different hashes it has, and how often the most frequent one."""
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, t[first], np.diff(np.append(first, len(t))))
    return np.bincount(t[first], minlength=n), most


def _line_counts(hasher: Hasher, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines that are not empty, and how many of them are different."""
    line = np.ones(256, dtype=bool)
    line[ord("\n")] = False
    hashes, _, _, before = hasher.words(data, starts, line)
    lines = np.diff(before)
    return lines, _distinct(np.repeat(np.arange(len(lines)), lines), hashes, len(lines))[0]


def vote(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    votes = np.zeros(table.shape, dtype=np.int64)
    for place, (name, (good, bad)) in enumerate(LABELLERS.items()):
        column = table[:, place]
        votes[:, place] = np.where(column >= bad, BAD, np.where(column <= good, GOOD, UNDECIDED))
        votes[words < LEAST_WORDS.get(name, 1), place] = SILENT
    return votes


def _names(votes: np.ndarray) -> list[str]:
    return ["".join(row) for row in votes.astype("U1").tolist()]


def hashed_features(hasher: Hasher, data: np.ndarray, starts: np.ndarray, table: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """For each text the buckets of its levels, then of its distinct words."""
    limits = np.array(list(LABELLERS.values()))
    level = np.clip(table / limits[:, 1] * (LEVELS // 2), 0, LEVELS - 1).astype(np.uint64)
    for place, name in enumerate(LABELLERS):
        level[words < LEAST_WORDS.get(name, 1), place] = LEVELS
    places = np.arange(len(LABELLERS), dtype=np.uint64) * np.uint64(2 * LEVELS) + np.uint64(1)
    mask = np.uint64((1 << HASH_BITS) - 1)
    levels = (finish(level + places) & mask).astype(np.int32)
    hashes, _, _, before = hasher.words(data, starts, _letter)
    buckets = (hashes & mask).astype(np.int32)
    return [np.concatenate([levels[i], np.unique(buckets[a:b])]) for i, (a, b) in enumerate(zip(before[:-1], before[1:]))]


def _texts(batches: Iterator[pa.RecordBatch], column: str = "text"):
    """Slices of the batches with their bytes, measures, words and vote patterns."""
    hasher = Hasher()
    for batch in batches:
        data, starts = byte_texts(batch.column(column))
        for first, last in slices(starts, BATCH_BYTES):
            part, cut = data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
            table, words = measures(hasher, part, cut)
            yield batch.slice(first, last - first), hasher, part, cut, table, words, _names(vote(table, words))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for *_, names in _texts(batches):
        found, n = np.unique(names, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.tolist(), pa.string()), pa.array(n, pa.int64())], ["pattern", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, hasher, data, starts, table, words, names in _texts(batches):
        found = [f.tobytes() for f in hashed_features(hasher, data, starts, table, words)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], ["pattern", "features"])


def _scores(weights, constant, hasher, data, starts, table, words) -> np.ndarray:
    index, value, doc = _sparse(hashed_features(hasher, data, starts, table, words))
    margin = np.bincount(doc, weights=weights[index] * value, minlength=len(words)) + constant
    return 1 / (1 + np.exp(-margin))


def _good(text: str, model: tuple[np.ndarray, float]):
    weights, constant = model[0].astype(np.float32), model[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, *measured, words, _ in _texts(batches, text):
            yield batch.filter(pa.array((_scores(weights, constant, *measured, words) >= 0.5) & (words > 0)))

    return work


def _scored(key: str, posterior: dict[str, float], model: tuple[np.ndarray, float]):
    weights, constant = model[0].astype(np.float32), model[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, hasher, data, starts, table, words, names in _texts(batches):
            score = _scores(weights, constant, hasher, data, starts, table, words)
            columns = [
                batch.column(key),
                pa.array(names, pa.string()),
                pa.array([posterior[name] for name in names], pa.float64()),
                pa.array(score, pa.float64()),
                pa.array((score >= 0.5) & (words > 0), pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "votes", "posterior", "score", "kept"])

    return work
