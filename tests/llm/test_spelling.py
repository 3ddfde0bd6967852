import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estatelake.llm.spelling import counted_runs, near_words, variants


def near(a, b):
    """One inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(words):
    found = {}
    for w, n in words.items():
        around = [(v, m) for v, m in words.items() if near(v, w)]
        best = min(around, key=lambda p: (-p[1], p[0].encode()), default=None)
        form = best if best and best[1] >= 10 * n else (None, None)
        found[w] = (form[0], n, len(around), form[1])

    def root(w):
        while found[w][0] is not None:
            w = found[w][0]
        return w

    return sorted((w, form, root(w), n, around, form_n) for w, (form, n, around, form_n) in found.items())


@pytest.mark.parametrize(("seed", "most_pairs"), [(1, 1), (2, 16), (3, 256)])
def test_near_words_at_every_depth_of_division(spark, seed, most_pairs):
    draw = random.Random(seed)
    words = {"".join(draw.choices("abé𝄞", k=draw.randrange(0, 9))) for _ in range(400)}
    frame = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long").repartition(3)
    got = sorted((r.word, r.near, r.near_n) for r in near_words(frame, most_pairs).collect())
    assert got == sorted((a, b, len(b)) for a in words for b in words if near(a, b))


def test_a_chunk_that_all_words_share(spark):
    draw = random.Random(5)
    words = {"common" * 3 + "".join(draw.choices("abcdefgh", k=4)) for _ in range(1500)}
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in near_words(frame, 64).collect()}
    assert got == {(a, b) for a in words for b in words if near(a, b)}


def test_forms_and_roots(spark):
    draw = random.Random(9)
    words = {}
    for k in range(40):
        base = "".join(draw.choices("abcdefg", k=8))
        for step in range(draw.randrange(1, 6)):
            words[base] = draw.choice([2, 20, 25, 250, 2500, 30000])
            i = draw.randrange(len(base))
            base = base[:i] + draw.choice(["", "x", "xy"]) + base[i + 1 :]
    words |= {"chainaaa": 1, "chainaab": 10, "chainaabb": 100, "chainabb": 1000, "chainbbb": 10_000, "chainbbbb": 1_000_000}
    frame = spark.createDataFrame([*words.items(), (None, 5), ("chainaaa", 1)], "word string, n long").repartition(4)
    got = sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(frame).collect())
    assert got == by_hand(words)


def runs_by_hand(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def test_runs_of_texts(spark):
    draw = random.Random(4)
    base = ["Straßenbahn", "ÉCOLES", "abcdefg", "abcdefgh", "short", "Ünfassbar×÷", "naïvement", "don't", "x" * 40]
    rows = [(i, draw.choice([" ", "\n", "1"]).join(draw.choices(base, k=30))) for i in range(200)]
    rows += [(None, "abcdefgh abcdefgh"), (1, None), (2, ""), (3, "abcdefghij " * 100_000), (3, "z" * 1_000_000), (4, "z" * 1_000_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    assert {r.word: r.n for r in counted_runs(docs, 7, 2, 31).collect()} == runs_by_hand(rows)


def test_empty_tables(spark):
    assert counted_runs(spark.createDataFrame([], "doc_id long, text string"), 7, 2, 31).collect() == []
    assert variants(spark.createDataFrame([], "word string, n long")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=6), st.text("ab", max_size=6))
def test_a_half_stands_in_every_near_word(a, b):
    """The pigeonhole: of two near words of lengths n and n or n + 1 a half of the first is in its place or shifted."""
    if near(a, b) and len(a) <= len(b):
        middle, shift = len(b) // 2, len(b) - len(a)
        # The region 0..middle or middle..len(b) of the longer word has the edit.
        in_first = b[middle:] == a[middle - shift :] if middle >= shift else False
        in_second = b[:middle] == a[:middle]
        assert in_first or in_second
