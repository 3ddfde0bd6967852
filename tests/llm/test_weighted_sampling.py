import hashlib
import random
import re
from collections import Counter

import numpy as np

from estatelake.llm.text_arrays import Hasher
from estatelake.llm.weighted_sampling import fingerprints, likeness, sample, term_weights


def jaccard(a, b):
    weights = []
    for text in (a, b):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall("[^\x20\x09-\x0d]+", lowered)
        weights.append(Counter({w: n * len(w.encode()) for w, n in Counter(words).items()}))
    a, b = weights
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, part string")
    return fingerprints(docs.repartition(5)).orderBy("doc_id").collect()


def test_against_the_definition(spark):
    draw = random.Random(9)
    vocabulary = [f"w{'x' * (i % 7)}{i}" for i in range(60)] + ["Ça", "ça", "A"]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randrange(0, 200))) for _ in range(60)]
    texts += [texts[5], None, "", "é", "   "]
    found = run(spark, texts)
    plain = [t or "" for t in texts]
    errors = []
    for i, r in enumerate(found):
        following = plain[(i + 1) % len(plain)]
        half = len(plain[i]) // 2
        edited = plain[i][: len(plain[i]) - half] + following[:half]
        assert (r.doc_id, r.n_chars) == (i, len(plain[i]))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [abs(r.near_edited - jaccard(plain[i], edited)), abs(r.near_next - jaccard(plain[i], following))]
    assert found[60].fingerprint == found[5].fingerprint
    assert max(errors) < 0.25 and np.mean(errors) < 0.05
    assert run(spark, texts) == found


def test_small_tables(spark):
    assert run(spark, []) == []
    only = run(spark, ["a b c"])
    assert [(r.near_next, r.n_chars) for r in only] == [(1.0, 5)]
    docs = spark.createDataFrame([(3, "a b"), (3, "a b"), (None, "z")], "doc_id long, text string")
    found = fingerprints(docs).collect()
    assert sorted((r.doc_id or 0, r.near_next) for r in found) == [(0, 0.0), (3, 0.0), (3, 1.0)]


def test_agreement_is_the_weighted_similarity():
    agree = []
    for seed in range(60):
        draws = np.random.default_rng(seed)
        words = [f"{seed}w{i}" for i in range(30)]
        texts = [" ".join(np.repeat(words, draws.integers(0, 6, 30))) for _ in range(2)]
        text, terms, weights = term_weights(Hasher(), [t.encode() for t in texts])
        marks = sample(text, terms, weights, 2)
        full = np.zeros(1, dtype=bool)
        agree.append(likeness(marks[:1], marks[1:], full, full)[0] - jaccard(*texts))
    assert abs(np.mean(agree)) < 0.02 and np.std(agree) < 0.06
