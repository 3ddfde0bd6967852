import random

import numpy as np
import pytest

from estatelake.llm.text_arrays import Hasher
from estatelake.llm.weak_labels import LABELLERS, classify, measures, pattern_posteriors


def measured(texts):
    data = [t.encode() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    table, words = measures(Hasher(), np.frombuffer(b"".join(data), dtype=np.uint8), starts)
    return [dict(zip(LABELLERS, row)) for row in table.tolist()], words.tolist()


def test_measures():
    (plain, loud, none, doubled), words = measured(["the cat sat on the mat.", "BUY!! NOW!! | BUY!!", "", "a a b b\n\na a b b\nc"])
    assert words == [6, 4, 0, 9]
    assert plain["sameness"] == pytest.approx(1 / 6) and plain["signs"] == 0 and plain["capitals"] == 0
    assert loud["capitals"] == 1 and loud["bars"] == 0.25 and loud["signs"] == pytest.approx(7 / 16) and loud["favourite"] == 0.5
    assert set(none.values()) == {0}
    assert doubled["repeats"] == pytest.approx(1 / 3) and doubled["stutter"] == pytest.approx(4 / 9)


def test_em_finds_the_accuracies_of_labellers():
    draw = random.Random(4)
    bad_on_bad, bad_on_good = [0.9, 0.7, 0.6, 0.5, 0.4, 0.3], [0.02, 0.05, 0.01, 0.03, 0.02, 0.01]
    counts, truth = {}, {}
    for _ in range(40000):
        good = draw.random() < 0.8
        votes = "".join("2" if draw.random() < r else "1" for r in (bad_on_good if good else bad_on_bad))
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + good
    posterior = pattern_posteriors(counts)
    wrong = sum(abs(posterior[v] * n - truth[v]) for v, n in counts.items()) / 40000
    assert wrong < 0.03
    assert pattern_posteriors({}) == {}


def test_junk_goes_and_clean_texts_stay(spark):
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefghilmnoprstuvé", k=draw.randrange(1, 9))) for _ in range(4000)]

    def clean():
        words = draw.choices(vocabulary, k=draw.choice([6, 30, 90, 400]))
        return ".\n".join(" ".join(words[i : i + 12]).capitalize() for i in range(0, len(words), 12)) + "."

    def junk():
        kind = draw.randrange(4)
        words = draw.choices(vocabulary, k=80)
        if kind == 0:
            return " ".join(w.upper() + "!!" for w in words)
        if kind == 1:
            return " | ".join(words)
        if kind == 2:
            return "buy now " * 60
        return "\n".join([" ".join(words[:6])] * 30)

    texts = [(i, junk() if i % 6 == 0 else clean(), "x") for i in range(1200)] + [(5000, None, "x"), (5001, " \n", "x"), (5002, "", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, kept string")
    found = {r.doc_id: r.kept for r in classify(docs.repartition(4)).collect()}
    assert len(found) == len(texts)
    assert np.mean([not found[i] for i in range(0, 1200, 6)]) > 0.97
    assert np.mean([found[i] for i in range(1200) if i % 6]) > 0.99
    assert not any(found[i] for i in (5000, 5001, 5002))


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = classify(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id").collect()
    assert np.mean([r.kept for r in found if r.quality == 1]) > 0.98
    assert np.mean([not r.kept for r in found if r.quality == 0]) > 0.9


def test_empty_table_and_equal_rows(spark):
    assert classify(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(1, "a text."), (1, "a text."), (None, "other words here")], "doc_id long, text string")
    found = classify(docs).collect()
    assert len(found) == 3 and len({r.score for r in found if r.doc_id == 1}) == 1
