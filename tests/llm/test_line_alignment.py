import hashlib
import random
from collections import Counter

import pytest

from estatelake.llm.line_alignment import LEAST_WORDS, patience, remove_shared_lines, shared_lines


def brute(rows):
    """All pairs through a shared anchor's first document, aligned by the rule."""
    split = {i: [x.strip() for x in t.split("\n")] if t else [] for i, t in rows}
    words = {i: [len(x.split()) for x in lines] for i, lines in split.items()}
    anchors = {}
    for i, lines in split.items():
        times = Counter(lines)
        anchors[i] = {x for x, n in zip(lines, words[i]) if n >= LEAST_WORDS and times[x] == 1}
    found = []
    for i, text in rows:
        gone = set()
        firsts = {min(j for j in split if x in anchors[j]) for x in anchors[i]}
        for j in firsts - {i}:
            gone |= set(shared_lines(split[j], split[i], words[i]))
        kept = "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone) if text else ""
        found.append((i, len(split[i]), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lines string")
    found = remove_shared_lines(docs.repartition(4)).orderBy("doc_id").collect()
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in found)
    return [(r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in found]


def test_like_brute_force(spark):
    draw = random.Random(3)
    lines = [" ".join(draw.choices("abcdefghé", k=draw.choice([0, 1, 2, 6, 9]))) for _ in range(120)]
    rows = [(i, "\n".join(draw.choice(["", " "]) + x for x in draw.choices(lines, k=draw.randrange(0, 15)))) for i in range(60)]
    rows += [(i, rows[draw.randrange(60)][1] + draw.choice(["", "\nan own line of many words"])) for i in range(60, 90)]
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, rows[0][1])]
    assert run(spark, rows) == brute(rows)


def test_passage_goes_from_later_documents_only(spark):
    passage = "one two three four five six"
    rows = [(i, f"own {i} line of this text\n{passage}\nshort") for i in range(40)]
    found = run(spark, rows)
    # The short last line stands beside the passage and goes with it.
    assert [r[2] for r in found] == [0] + [2] * 39


def test_empty_table_equal_and_null_ids(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    found = remove_shared_lines(docs).collect()
    assert sorted(r.n_removed for r in found if r.doc_id == 1) == [0, 1]
    assert [r.n_removed for r in found if r.doc_id is None] == [1]


@pytest.mark.parametrize("seed", range(30))
def test_patience_aligns_equal_lines_in_order(seed):
    draw = random.Random(seed)
    a = [draw.randrange(12) for _ in range(draw.randrange(15))]
    b = [draw.randrange(12) for _ in range(draw.randrange(15))]
    found = patience(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert all(x < y for p, q in zip(found, found[1:]) for x, y in zip(p, q))
    unique = {x for x in a if a.count(x) == 1 and b.count(x) == 1}
    if a == b:
        assert len(found) == len(a)
    if unique:
        assert found


def test_patience_prefers_unique_lines():
    assert patience(list("xAyBx"), list("AzBxx")) == [(1, 0), (3, 2), (4, 4)]
