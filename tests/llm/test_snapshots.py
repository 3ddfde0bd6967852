import random

from estatelake.llm.snapshots import collapse

SCHEMA = "conv_id long, turn int, role string, text string, place string"


def brute(rows):
    turns = {}
    for conv, *turn in rows:
        turns.setdefault(conv, set()).add(tuple(turn[:3]))
    ordered = {c: sorted(t, key=lambda x: tuple((v is not None, v or type(v)() if v is not None else 0) for v in x)) for c, t in turns.items()}
    tails = {c: [x[1:] for x in t] for c, t in ordered.items()}
    found = {}
    for c, own in tails.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in tails.values())
        same = [d for d, o in tails.items() if o == own]
        first = min(same, key=lambda d: (d is None, d or 0)) == c
        text = "".join(f"<|{'unknown' if r is None else r}|>\n{t or ''}\n<|end|>\n" for _, r, t in ordered[c])
        found[c] = (len(own), first and not longer, text if first and not longer else None)
    return found


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found = collapse(frame.repartition(3)).collect()
    assert len({r.conv_id for r in found}) == len(found)
    assert all(r.n_chars == (None if r.rendered is None else len(r.rendered)) for r in found)
    return {r.conv_id: (r.n_turns, r.kept, r.rendered) for r in found}


def test_like_brute_force(spark):
    draw = random.Random(2)
    logs = [[(draw.choice(["user", "assistant", None]), draw.choice(["hi", "ok", "é", None, ""])) for _ in range(draw.randrange(1, 9))] for _ in range(25)]
    rows, conv = [], 0
    for log in logs:
        for length in draw.sample(range(1, len(log) + 1), draw.randrange(1, len(log) + 1)):
            rows += [(conv, i, *turn) for i, turn in enumerate(log[:length])]
            conv += 1
    rows += [(None, 0, "user", "hi"), (None, None, "user", "early"), *rows[:5], (900, 1, "user", "a"), (900, 1, "user", "b")]
    draw.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == {}
