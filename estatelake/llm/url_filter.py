"""URL filter: rules where they fit, elsewhere a ratio of two character language models.

A rule names a host, with all its subdomains, and the beginning of a path; of the rules
that fit a url the longest decides.  The distinct urls that a rule accepts and those that
a rule rejects train one smoothed variable-order Markov model each.  In a model a
character follows its context of up to ``ORDER`` characters:

    P(c | context) = (count(context c) + kinds(context) * P(c | shorter context)) / (count(context) + kinds(context))

where ``kinds`` is the number of different characters seen after the context; below the
empty context all ``ALPHABET`` characters are equally likely.  A url's score is the
difference of its log-likelihoods, accepted minus rejected, divided by its number of
characters.  Every ``CALIBRATION_OF``-th of the ruled urls (by a hash) trains nothing and
calibrates: the threshold is the edge between two bins at which the share of right verdicts,
averaged over the two sides, is largest, the nearest to zero if there are several.

All of it is DataFrame functions.  Models are tables of distinct strings of at most
``ORDER + 1`` characters; the interpolation runs once for each distinct string, and a url
is the sum of its strings' values in whole millionths, so no sum depends on its order.
Joins are on these strings; a string that all urls have is counted before it is
shuffled, and on the side of the urls it is a plain scan that Spark can split.

A url without "://" and a null one have empty host and path; they are judged like any
text.  Each row is judged, equal urls equally; equal urls train once.  Without any ruled urls of
one side the other model stands alone against equally likely characters.  Texts of any
length are cut into characters once.  Other columns are not looked at, also such as
``host`` or ``rule``.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.functions.hashing import hash_bucket
from estatelake.staging import stage

ALLOW, BLOCK = "allow", "block"
# Longest context of a character.
ORDER = 4
ALPHABET = 256
CALIBRATION_OF = 5
# Bins of the score for each nat.
BINS = 50
MILLION = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Marks before and after a text; in a url they are escaped.
START, END = "\x02", "\x03"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def judge(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Rows (key, host, path, rule, verdict, score); the score is that of the models, ruled or not."""
    split = pages.select(F.col(key), *host_and_path(F.col(url)))
    texts = stage(split.select("host", "path").distinct().select("*", *fitting_rule(rules)), "urls")
    scored = stage(model_scores(texts), "url-scores")
    limit = threshold(scored)
    judged = scored.select(
        F.col("host").alias("host__"), F.col("path").alias("path__"), "rule",
        F.coalesce("ruled", F.when(F.col("score") >= limit, ALLOW).otherwise(BLOCK)).alias("verdict"), "score",
    )
    same = (F.col("host") == F.col("host__")) & (F.col("path") == F.col("path__"))
    return split.join(judged, same).select(key, "host", "path", "rule", "verdict", "score")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty where there is no "://"."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), UPPER, LOWER)
    return host.alias("host"), F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1).alias("path")


def fitting_rule(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, as text, and its verdict; null if none fits.

    The rules become one expression, so they are meant to be hundreds, not millions.  Of
    equal rules the first decides.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.host) + len(r.path)):
        host = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        fits = host & F.col("path").startswith(r.path)
        rule = F.when(fits, r.host + r.path).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return rule.alias("rule"), verdict.alias("ruled")


def strings(text: Column) -> Column:
    """The string of ``ORDER`` characters and the next one for each character of a text and its end.

    The characters are bound once: an expression inside ``transform`` is evaluated for each element.
    """
    marked = F.split(F.concat(F.lit(START * ORDER), text, F.lit(END)), "")

    def cut(chars: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(chars) - ORDER), lambda i: F.array_join(F.slice(chars, i, F.lit(ORDER + 1)), "")
        )

    return F.transform(F.array(marked), cut)[0]


def model_scores(texts: DataFrame) -> DataFrame:
    """``texts`` with ``calibrates`` and ``score``."""
    text = F.concat("host", "path")
    numbered = stage(
        texts.withColumns(
            {"text": text, "calibrates": F.col("ruled").isNotNull() & (hash_bucket(text, CALIBRATION_OF) == 0)}
        ).withColumn("number", F.monotonically_increasing_id()),
        "url-texts",
    )
    side = F.when(~F.col("calibrates"), F.col("ruled"))
    whole = numbered.select("number", side.alias("side"), F.explode(strings(F.col("text"))).alias("string"))
    counted = whole.groupBy("string").agg(
        *[F.sum(F.when(F.col("side") == s, 1).otherwise(0)).alias(s) for s in (ALLOW, BLOCK)]
    )
    values = stage(string_values(stage(counted, "url-strings")), "string-values")
    found = stage(whole.select("number", "string"), "url-places").join(values, "string")
    sums = found.groupBy("number").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))
    score = F.col("value") / (F.col("n") * MILLION)
    return numbered.join(sums, "number").select("host", "path", "rule", "ruled", "calibrates", score.alias("score"))


def string_values(counted: DataFrame) -> DataFrame:
    """Rows (string, value): difference of the two log-probabilities of its last character, in millionths.

    ``counted`` has how often each string of ``ORDER + 1`` characters is in accepted and in
    rejected urls; the shorter strings' counts follow from it.
    """
    orders = F.sequence(F.lit(1), F.lit(ORDER + 1))
    ends = counted.select("string", ALLOW, BLOCK, F.explode(orders).alias("size"))
    tail = F.substring("string", F.lit(ORDER + 2) - F.col("size"), F.col("size"))
    # The last ``size`` characters: a character and its context of size - 1 before it.
    grams = ends.select("string", "size", tail.alias("gram"), ALLOW, BLOCK)
    by_gram = stage(grams.groupBy("gram").agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK)), "url-grams")
    context = F.substring("gram", F.lit(1), F.length("gram") - 1)
    by_context = by_gram.groupBy(context.alias("context")).agg(
        *[F.sum(s).alias(f"{s}_all") for s in (ALLOW, BLOCK)],
        *[F.sum((F.col(s) > 0).cast("long")).alias(f"{s}_kinds") for s in (ALLOW, BLOCK)],
    )
    known = by_gram.withColumn("context", context).join(stage(by_context, "url-contexts"), "context").drop("context")
    joined = grams.select("string", "size", "gram").join(stage(known, "url-model"), "gram")
    numbers = [f"{s}{kind}" for s in (ALLOW, BLOCK) for kind in ("", "_all", "_kinds")]
    listed = joined.groupBy("string").agg(F.array_sort(F.collect_list(F.struct("size", *numbers))).alias("levels"))
    logs = {s: F.log(_probability(s)) for s in (ALLOW, BLOCK)}
    return listed.select("string", F.round((logs[ALLOW] - logs[BLOCK]) * MILLION).cast("long").alias("value"))


def _probability(side: str) -> Column:
    """From equally likely characters up to the longest context; unseen contexts change nothing."""

    def longer(shorter: Column, level: Column) -> Column:
        kinds, every = level[f"{side}_kinds"], level[f"{side}_all"]
        return F.when(every > 0, (level[side] + kinds * shorter) / (every + kinds)).otherwise(shorter)

    return F.aggregate("levels", F.lit(1.0 / ALPHABET), longer)


def threshold(scored: DataFrame) -> Column:
    """The least score of an accepted url, from the histogram of the calibrating ones; 0 without both sides.

    An edge lies midway between two occupied bins.  A score is less than some hundred
    nats, so there are some thousand bins at most, however many urls.
    """
    bins = (
        scored.where("calibrates")
        .groupBy(F.floor(F.col("score") * BINS).alias("bin"))
        .agg(*[F.sum((F.col("ruled") == s).cast("long")).alias(s) for s in (ALLOW, BLOCK)])
    )
    rising = Window.orderBy("bin")
    above = F.sum(ALLOW).over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    below = F.coalesce(F.sum(BLOCK).over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    right = above * F.sum(BLOCK).over(every) + below * F.sum(ALLOW).over(every)
    edge = (F.col("bin") + F.coalesce(F.lag("bin").over(rising) + 1, F.col("bin"))) / (2 * BINS)
    edges = bins.select(edge.alias("edge"), right.alias("right")).where("right > 0")
    best = edges.agg(F.min(F.struct((-F.col("right")).alias("wrong"), F.abs("edge").alias("far"), "edge")).alias("best"))
    return F.coalesce(best.select("best.edge").scalar(), F.lit(0.0))
