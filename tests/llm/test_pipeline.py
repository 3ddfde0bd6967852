"""The pipeline against plain readings of each stage's contract, on a small table with odd rows."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_line_alignment import brute as brute_lines
from tests.llm.test_one_permutation import brute as brute_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(12)
    vocabulary = ["".join(draw.choices("abcdefgilmnoprstuvé", k=draw.randrange(2, 9))) for _ in range(900)]

    def text(n):
        words = draw.choices(vocabulary, k=n)
        return "\n".join(" ".join(words[i : i + 10]).capitalize() + "." for i in range(0, n, 10))

    found = [(i, text(draw.choice([8, 40, 150])), "en", draw.choice(["a", "b", "c", None]), i) for i in range(300)]
    for i in range(300, 360):
        words = found[i - 300][1].replace("\n", " ").split(" ")
        words[draw.randrange(len(words))] = "changed"
        found.append((i, " ".join(words), None, "b", None))
    found += [(i, found[i - 360][1], "en", "a", 1) for i in range(360, 380)]
    found += [(i, " ".join(w.upper() + "!!" for w in draw.choices(vocabulary, k=50)), "xx", "junk", 0) for i in range(380, 440)]
    return [*found, (440, None, None, None, None), (441, "", "", "", 0), (None, text(60), "en", "a", 3), found[7], found[7]]


@pytest.fixture(scope="module")
def stages(spark, rows, tmp_path_factory):
    """The table before the first stage and after each."""
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    frames = [docs]
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        step(spark, frames[-1], "unused").write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def test_columns_stay_until_the_last(stages):
    assert all(f.columns == stages[0].columns for f in stages[:-1])
    assert "sequence_id" in stages[-1].columns


def test_classifier_keeps_clean_rows_whole(stages, rows):
    kept = Counter(tuple(r) for r in stages[1].collect())
    clean = [r for r in rows if r[1] and r[3] != "junk"]
    assert not kept - Counter(rows)
    assert sum((Counter(clean) & kept).values()) >= 0.99 * len(clean)
    assert not any(r[3] == "junk" or not r[1] for r in kept)


def test_line_dedup_is_the_operator(stages):
    before, after = [sorted(map(tuple, f.collect()), key=str) for f in stages[1:3]]
    unique = Counter(r[0] for r in before)
    removed = {i: (lines, gone) for i, lines, gone, _ in brute_lines([(r[0], r[1]) for r in before if unique[r[0]] == 1 and r[0] is not None])}
    texts = {r[0]: r[1] for r in after}
    for r in before:
        if unique[r[0]] == 1 and r[0] in removed:
            lines, gone = removed[r[0]]
            assert (len(texts[r[0]].split("\n")) if r[0] in texts else 0) in (lines - gone, 0)
    # Of rows that are the same the first stays.
    assert sum(r[0] == 7 for r in after) == 1


def test_near_duplicates_leave_one_of_each_group(stages):
    before, after = [f.collect() for f in stages[2:4]]
    rows = sorted((r.doc_id, r.text) for r in before if r.doc_id is not None)
    groups = {i: component for i, _, component in brute_groups(rows, 5, (80, 100))}
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(set(groups.values()))
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_mix_repeats_whole_rows(stages):
    before, after = [Counter(map(tuple, f.collect())) for f in stages[3:5]]
    assert set(after) <= set(before) and max(after.values()) <= 3


def test_packing_places_every_token_once(stages):
    docs, pieces = stages[4].collect(), stages[5].collect()
    ids = Counter(r.doc_id for r in docs)
    assert Counter(r.doc_id for r in pieces if r.start == 0) == ids
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_on_an_empty_folder(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_duplicates_take_five_words_and_four_fifths():
    assert (corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.LEAST_SIMILARITY) == (5, (80, 100))
