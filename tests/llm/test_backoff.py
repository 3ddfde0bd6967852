import math
import random
import re
import zlib
from collections import Counter

from estatelake.llm.backoff import ADDED, DISCOUNT, LEAST_COUNT, score


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", lowered) + [None]


def held_out(key):
    return zlib.crc32(str(key).encode()) % 10 == 0


def brute(rows):
    train = [tokens(t) for k, t in rows if not held_out(k)]
    words = Counter(w for t in train for w in t)
    n, v = sum(words.values()), len(words)
    pairs = Counter(p for t in train for p in zip(["<s>", *t], t))
    context = Counter({**words, "<s>": len(train)})

    def alone(w):
        return (words[w] + ADDED) / (n + ADDED * (v + 1))

    def weight(h, w):
        arcs = {x: c for (g, x), c in pairs.items() if g == h and c >= LEAST_COUNT}
        left = 1 - sum(c - DISCOUNT for c in arcs.values()) / max(context[h], 1)
        return max(arcs.get(w, 0) - DISCOUNT, 0) / max(context[h], 1) + left * alone(w)

    found = {}
    for k, t in rows:
        t = tokens(t)
        base = sum(math.log10(alone(w)) for w in t)
        whole = sum(math.log10(weight(h, w)) for h, w in zip(["<s>", *t], t))
        found[k] = (held_out(k), len(t), sum(words[w] > 0 for w in t), n, round(base, 6), round(whole, 6))
    states = {"<s>", *(w for w in words if w)}
    for h in list(states)[:10]:
        assert abs(sum(weight(h, w) for w in words) + weight(h, "never seen") - 1) < 1e-9
    return found


def run(spark, rows):
    docs = spark.createDataFrame([(k, t, 0.5) for k, t in rows], "doc_id long, text string, score double")
    return {
        r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in score(docs.repartition(3)).collect()
    }


def test_like_brute_force_and_sums_to_one(spark):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["A", "a", "é", "É"]
    rows = [(i, draw.choice([" ", "\n", " \t"]).join(draw.choices(vocabulary, k=draw.randrange(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, "  "), (102, "never " * 3), (103, rows[0][1])]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_no_training(spark):
    assert run(spark, []) == {}
    alone = next(k for k in range(100) if held_out(k))
    assert run(spark, [(alone, "a b")]) == {alone: (True, 3, 0, 0, 0.0, 0.0)}


def test_better_than_single_words_on_held_out_texts(spark):
    draw = random.Random(6)
    phrases = [[f"p{i}{j}" for j in range(5)] for i in range(30)]
    rows = [(i, " ".join(w for _ in range(20) for w in draw.choice(phrases))) for i in range(200)]
    found = run(spark, rows)
    gains = [f[5] - f[4] for f in found.values() if f[0]]
    assert gains and min(gains) > 0


def test_a_bigram_held_once_is_an_arc(spark):
    trained = [k for k in range(100) if not held_out(k)][:2]
    asked = next(k for k in range(100) if held_out(k))
    rows = [(trained[0], "a b c"), (trained[1], "c a d"), (asked, "a b")]
    n, v = 8, 5

    def alone(count):
        return (count + 0.1) / (n + 0.1 * (v + 1))

    # Each known state here: all its arcs have count 1, and half of each goes to the failure arc.
    steps = [(1, 2, 2), (1, 2, 1), (0, 1, 2)]
    wanted = sum(math.log10((0.5 / h if arc else 0) + 0.5 * alone(w)) for arc, h, w in steps)
    assert run(spark, rows)[asked][5] == round(wanted, 6)
