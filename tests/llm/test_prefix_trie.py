import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from estatelake.llm import prefix_trie
from estatelake.llm.queries import rebuilt_turns

SCHEMA = "conv_id long, turn long, role string, text string, depth string, words string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        return [node] + [n for child in children[node] for n in below(child)]

    words = {n: len(re.findall("[^\x20\x09-\x0d]+", n[-1][1])) if n else 0 for n in members}
    found = []
    for node, convs in members.items():
        tree = below(node)
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        found.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            sum(not children[n] for n in tree), sum((len(members[n]) - 1) * words[n] for n in tree), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def conversations(seed, n=70):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-30, 130), n):
        for turn in draw.sample([None, 0, 1, 2, 3, 5, 8], draw.randrange(1, 7)):
            rows.append((c, turn, draw.choice(["user", None, "é"]), draw.choice(["hi", "hi", "a b\tc", "", None, "ü 1"])))
    return rows + [(None, 1, "user", "lost")] * 3


def found(spark, rows, parts=4):
    given = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts)
    trie = prefix_trie.prefix_trie(*rebuilt_turns(prefix_trie.numbered_turns(given)))
    return trie.select(COLUMNS + ["enter", "exit"]).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_walking_the_tree(spark, monkeypatch, seed):
    monkeypatch.setattr(prefix_trie, "RANKED_AT_ONCE", 20)
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 1)
    monkeypatch.setattr(prefix_trie, "IDS_IN_PIECE", 3)
    rows = conversations(seed)
    got = found(spark, rows)
    assert sorted((tuple(r[: len(COLUMNS)]) for r in got), key=str) == by_hand(rows)
    # The arcs' places are those of a tour: all different, and a subtree is an interval.
    assert sorted(p for r in got for p in (r.enter, r.exit)) == list(range(2 * len(got)))
    assert all(r.enter < r.exit for r in got)


def test_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 600, 20) for t in range(3)]
    rows += [(4000, t, "user", f"line {t}") for t in range(9000)] + [(4020, None, None, "x" * 2_000_000)]
    got = found(spark, rows)
    assert sorted((tuple(r[: len(COLUMNS)]) for r in got), key=str) == by_hand_of_chains(rows)


def by_hand_of_chains(rows):
    """Like ``by_hand``, without recursion: every node but the root has one child at most."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn, role or "", text or ""))
    assert all(turns == sorted(turns, key=lambda t: (t[0] is not None, t[0])) for turns in own.values())
    whole, chains = {}, defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(t[1:] for t in own.get(c - c % 20, [])[:h] + turns[h:])
    for c, turns in whole.items():
        chains[turns].append(c)
    assert len({t[:1] for t in chains}) == len(chains)
    found, saved = [], 0
    for turns, convs in chains.items():
        below = 0
        for d in range(len(turns), 0, -1):
            below += (len(convs) - 1) * len(turns[d - 1][1].split())
            last = d == len(turns)
            ends = ",".join(map(str, sorted(convs))) if last else ""
            parent = min(convs) if d > 1 else min(whole)
            found.append((min(convs), d, parent, len(convs), int(not last), 1, below, hashlib.sha256(ends.encode()).hexdigest()))
        saved += below
    root = (min(whole), 0, None, len(whole), len(chains), len(chains), saved, hashlib.sha256(b"").hexdigest())
    return sorted([*found, root], key=str)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []
