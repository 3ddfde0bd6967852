import hashlib
import math
import random
import re
from collections import Counter

import pytest

from estatelake.llm.queries import RULES
from estatelake.llm.url_filter import ALPHABET, BINS, CALIBRATION_OF, END, ORDER, START, Rule, judge

SCHEMA = "page_id long, url string, host string, rule int"


def split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


class Model:
    def __init__(self, texts):
        self.after = {}
        for text in texts:
            marked = START * ORDER + text + END
            for i in range(ORDER, len(marked)):
                for k in range(ORDER + 1):
                    self.after.setdefault(marked[i - k : i], Counter())[marked[i]] += 1

    def log(self, context, c):
        p = 1 / ALPHABET
        for k in range(ORDER + 1):
            seen = self.after.get(context[ORDER - k :])
            if seen:
                p = (seen[c] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return math.log(p)


def by_hand(urls, rules):
    texts = {split(u) for u in urls}
    ruled = {t: rule_of(*t, rules) for t in texts}
    aside = {t for t in texts if ruled[t] and int(hashlib.md5("".join(t).encode()).hexdigest()[:8], 16) % CALIBRATION_OF == 0}
    models = [Model("".join(t) for t in texts - aside if ruled[t] and ruled[t].verdict == v) for v in ("allow", "block")]
    score = {}
    for t in texts:
        marked = START * ORDER + "".join(t) + END
        at = [(marked[i - ORDER : i], marked[i]) for i in range(ORDER, len(marked))]
        score[t] = sum(round((models[0].log(*x) - models[1].log(*x)) * 1e6) for x in at) / 1e6 / len(at)
    bins = {t: math.floor(score[t] * BINS) for t in aside}
    sides = {v: [bins[t] for t in aside if ruled[t].verdict == v] for v in ("allow", "block")}
    best, last = None, None
    for b in sorted(set(bins.values())):
        edge = (b + (b if last is None else last + 1)) / (2 * BINS)
        right = sum(x >= b for x in sides["allow"]) * len(sides["block"]) + sum(x < b for x in sides["block"]) * len(sides["allow"])
        if right:
            best = min(best or (1, 0, 0), (-right, abs(edge), edge))
        last = b
    limit = best[2] if best else 0.0
    return {
        t: (r.host + r.path if r else None, r.verdict if r else "allow" if score[t] >= limit else "block", score[t]) for t, r in ruled.items()
    }


def urls(n, seed):
    draw = random.Random(seed)
    names = ["blog.thing", "www.a-b", "cheap", "m.ö", "THING"]
    return [
        f"{draw.choice(['http', 'https'])}://{draw.choice(names)}.example.{draw.choice(['org', 'com', 'net', 'COM'])}"
        f"/{draw.choice(['en', 'en', 'fr', 'de', 'es'])}/{draw.randrange(300)}{draw.choice(['', '?a=://b/', '#top', '/'])}"
        for _ in range(n)
    ]


def checked(spark, given, rules):
    rows = [(i, u, "x", 1) for i, u in enumerate(given)]
    found = judge(spark.createDataFrame(rows, SCHEMA).repartition(3), rules).collect()
    wanted = by_hand(given, rules)
    assert sorted(r.page_id for r in found) == list(range(len(given)))
    for r in found:
        rule, verdict, score = wanted[split(given[r.page_id])]
        assert (r.host, r.path, r.rule) == (*split(given[r.page_id]), rule), given[r.page_id]
        assert r.score == pytest.approx(score, abs=2e-5)
        assert r.verdict == verdict, given[r.page_id]


def test_equals_the_models_by_hand(spark):
    odd = [None, "", "no-scheme.org/fr/", "://", "x://org", "x://ORG/", "x://org?/fr/", "a://b://c.org/", "x://notorg/", "x://é.com/fr/ü", "x://h/" + "ab/" * 9000]
    checked(spark, urls(400, 1) + odd + ["https://same.example.com/fr/1"] * 50, RULES)


def test_longest_rule_wins_and_one_side_may_be_missing(spark):
    rules = [Rule("allow", "com", ""), Rule("block", "com", "/d"), Rule("allow", "example.com", "/de/1"), Rule("block", "com", "")]
    checked(spark, urls(80, 2), rules)
    checked(spark, urls(60, 3), [Rule("block", "com", "/")])
    checked(spark, urls(20, 4), [])


def test_empty_table(spark):
    found = judge(spark.createDataFrame([], SCHEMA), RULES)
    assert found.collect() == [] and found.columns == ["page_id", "host", "path", "rule", "verdict", "score"]


def test_main_path_has_no_python(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(urls(30, 5))]
    plan = judge(spark.createDataFrame(rows, SCHEMA), RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
