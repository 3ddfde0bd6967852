import random
import re
from collections import defaultdict

import pytest

from estatelake.llm.mixing import apportion, level_targets, mix, take


def highest_quotients(votes, seats):
    given = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        given[best] += 1
    return given


@pytest.mark.parametrize("seed", range(20))
def test_apportion_is_highest_quotients(seed):
    draw = random.Random(seed)
    votes = [draw.choice([0, 1, 7, draw.random() * 1000]) for _ in range(draw.randrange(1, 60))]
    seats = draw.randrange(0, 3000)
    if sum(votes):
        assert list(apportion(votes, seats)) == highest_quotients(votes, seats)


def test_targets_stop_at_three_times_the_source():
    targets = level_targets([1000, 10, 100, 0], [1, 2, 3, 1])
    assert targets == [780.0, 30.0, 300.0, 0.0]
    assert level_targets([], []) == []
    assert sum(level_targets([5, 5], [1, 3])) == 10


def documents(seed):
    draw = random.Random(seed)
    rows = []
    for i in range(900):
        source = draw.choice(["a", "b", "É", "big", "big", "big", None, "", "Z"])
        words = draw.choice([0, 1, 30, 300]) if source != "Z" else 40
        rows.append((i, draw.choice([" ", "\n\t"]).join(["w"] * words) if words else draw.choice(["", None, " "]), source, 1))
    return rows


def test_sources_come_near_their_targets(spark):
    rows = documents(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    found = mix(docs.repartition(4)).collect()
    size = {i: len(re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t, *_ in rows}
    source = {i: s for i, _, s, _ in rows}
    by_source, taken = defaultdict(int), defaultdict(int)
    for i, s in source.items():
        by_source[s] += size[i]
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(names, level_targets([by_source[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])))
    for r in found:
        assert (r.size, r.source_size) == (size[r.doc_id], by_source[source[r.doc_id]])
        assert r.target == pytest.approx(wanted[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s in names:
        assert abs(taken[s] - wanted[s]) <= 48, s
    assert sorted(found) == sorted(mix(docs.repartition(7)).collect())


def test_empty_table_and_equal_ids(spark):
    schema = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], schema)).collect() == []
    docs = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, None, None)], schema)
    assert sorted((r.doc_id or 0, r.size) for r in mix(docs).collect()) == [(0, 0), (1, 2), (1, 2)]


def test_take_repeats_whole_documents(spark):
    rows = documents(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    mixed = mix(docs)
    kept = take(docs, mixed).groupBy("doc_id").count().collect()
    taken = {r.doc_id: (r.taken, r.size) for r in mixed.collect()}
    for r in kept:
        words, size = taken[r.doc_id]
        assert r["count"] == 1 if not size else abs(r["count"] - words / size) < 1
    assert take(docs, mixed).columns == docs.columns


def test_many_equal_rows_have_places_of_their_own(spark):
    rows = [(7, "w " * 61, "a")] * 500 + [(i, "w " * 40, "b") for i in range(10, 310)]
    found = mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()
    for name in ("a", "b"):
        mine = [r for r in found if r.doc_id == 7] if name == "a" else [r for r in found if r.doc_id != 7]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 48, name
