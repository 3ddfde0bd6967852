import random
import re

import numpy as np
import pytest

from estatelake.llm import one_permutation
from estatelake.llm.components import connected_components
from estatelake.llm.one_permutation import BINS, donor_table, near_duplicates, signature


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    w = re.findall("[^\x20\x09-\x0d]+", lower(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, least):
    sets = [shingles(t, width) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and least[1] * both >= least[0] * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return sorted((rows[i][0], len(sets[i]), min(rows[j][0] for j in range(len(rows)) if group[j] == g)) for i, g in enumerate(group))


@pytest.mark.parametrize("width, least", [(3, (85, 100)), (5, (80, 100))])
def test_like_brute_force(spark, width, least):
    draw = random.Random(width)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "A", "a"]
    rows = []
    for base in range(25):
        words = draw.choices(vocabulary, k=draw.choice([1, 2, 4, 40, 200, 900]))
        for copy in range(draw.choice([1, 2, 12])):
            edited = list(words)
            for _ in range(draw.randrange(0, 1 + len(words) // 25)):
                edited[draw.randrange(len(edited))] = draw.choice(vocabulary)
            rows.append(draw.choice([" ", "\n", "\t "]).join(edited))
    rows += ["", None, " \n", "One", "one", "two words", "TWO  words"]
    rows = list(enumerate(draw.sample(rows, len(rows))))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int")
    found = near_duplicates(docs.repartition(4), width=width, least=least).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, width, least)
    assert all(r.kept == r.keeper == (r.doc_id == r.component_id) for r in found)


def test_empty_table_equal_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    docs = spark.createDataFrame([(7, "a b c"), (7, "a b c"), (None, "a b c"), (None, "x"), (9, "A b C")], "doc_id long, text string")
    found = near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [
        (0, 0, True), (0, 7, False), (7, 7, True), (7, 7, True), (9, 7, False)
    ]
    assert sum(r.keeper for r in found) == 2


def test_signature_agreement_is_similarity():
    draws = np.random.default_rng(1)
    agreed = []
    for _ in range(200):
        union = np.unique(draws.integers(0, 1 << 63, 20).astype(np.uint64) * np.uint64(2))
        a, b = signature(
            [union, np.sort(draws.permutation(union)[:17])], donor_table()
        )
        agreed.append(np.mean(a == b))
    assert BINS == len(a)
    assert abs(np.mean(agreed) - 0.85) < 0.03


def test_components_of_chains_and_stars(spark):
    draw = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    draw.shuffle(chain)
    found = connected_components(spark.createDataFrame(chain, "x long, y long"))
    assert {r.node: r.component for r in found.collect()} == {
        **{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}
    }


def replaced(draw, words, n, name):
    edited = list(words)
    for k, place in enumerate(draw.sample(range(1, len(words) - 1), n)):
        edited[place] = f"{name}x{k}"
    return edited


def test_hub_after_its_thousand_copies(spark):
    draw = random.Random(11)
    hub = [f"h{i}" for i in range(300)]
    rows = [(i, " ".join(replaced(draw, hub, 7, f"c{i}"))) for i in range(1000)] + [(1000, " ".join(hub))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: 0 for i in range(1001)}


def test_pairs_inside_a_family_of_strangers(spark, monkeypatch):
    from estatelake.llm import one_permutation

    monkeypatch.setattr(one_permutation, "PART", 1 << 13)
    draw = random.Random(12)
    template = [f"t{i}" for i in range(300)]
    texts = [replaced(draw, template, 9, f"c{i}") for i in range(200)]
    texts += [replaced(draw, words, 3, f"d{i}") for i, words in enumerate(texts[20:200:6])]
    # A group of its own among the strangers, larger than a part.
    texts += [replaced(draw, texts[7], 1, f"e{i}") for i in range(60)]
    rows = list(enumerate(" ".join(words) for words in draw.sample(texts, len(texts))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = near_duplicates(docs).collect()
    wanted = brute(rows, 3, (85, 100))
    assert 100 < len({c for _, _, c in wanted}) < 250
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == wanted
