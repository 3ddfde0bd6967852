"""Spelling variants: words one edit apart, joined by asymmetric chunks.

Two words are near if one inserted, deleted or replaced code point makes one the other.
One word contributes two disjoint chunks, its halves; the other one its positional grams.
One edit lies in one half at most, so the other half stands whole in the near word, in
its place or shifted by one where the words' lengths differ by one.  Of a word's grams
only those can meet a chunk that have the length and place of a half of a word of its own
length or of one code point less, so these are sent.

A row says "outside of places lo..hi I am ``rest``": the rest of a half is its chunk.
Longer words (``long``) may lose or replace one code point in the region, shorter ones
gain one there.  A pair meets where its rests are equal, and is verified as a whole.

A chunk that very many words share would make all pairs of them.  Such a bucket is divided: in
what its words do not share each again contributes two chunks, and so on down to one
place, where only words meet that are near, or that gain a code point beside each other's.
Buckets are divided until they make ``MOST_PAIRS`` pairs at most, so the pairs are of the
order of the words and their links, whatever the words; no pair is lost.

Words are compared by code point.  A null word is no word, and repeated words count once, with the
largest number.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.staging import stage

MOST_PAIRS = 256
# How much more often than a word its form is, at least.
FORM_RATIO = 10
BUCKET = ["size", "lo", "hi", "rest"]


def variants(words: DataFrame) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for the rows (word, n)."""
    words = stage(words.where("word is not null").groupBy("word").agg(F.max("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rare"), "near")).alias("best")
    found = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = words.join(found, "word", "left")
    is_form = -F.col("best.rare") >= FORM_RATIO * F.col("n")
    judged = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.rare")).alias("form_n"),
    )
    judged = stage(judged, "forms")
    return judged.join(roots(judged.where("form is not null").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def near_words(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Rows (word, near, near_n), both ways and without repeats, for distinct words (word, n)."""
    rows = stage(halves(words), "chunks")
    pairs = []
    while True:
        tagged = stage(_tagged(rows, most_pairs), "shared-chunks")
        pairs.append(stage(_met(tagged.where("final")), "near-words"))
        rest = tagged.where("not final")
        if rest.isEmpty():
            break
        rows = stage(divided(rest), "chunks")
    found = pairs[0]
    for more in pairs[1:]:
        found = found.union(more)
    return found.distinct()


def halves(words: DataFrame) -> DataFrame:
    """Each word as a long one in its own length, and as a short one in the next length."""
    size = F.char_length("word")
    roles = F.array(
        F.struct(size.alias("size"), F.lit(True).alias("long")), F.struct((size + 1).alias("size"), F.lit(False).alias("long"))
    )
    both = words.select("word", "n", F.inline(roles))
    return _regions(both, F.lit(0), F.col("size"))


def divided(rows: DataFrame) -> DataFrame:
    return _regions(rows, F.col("lo"), F.col("hi"))


def _regions(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """The two halves of the region lo..hi as regions of their own, those that are not empty."""
    middle = F.floor((lo + hi) / 2).cast("int")
    two = F.array(F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi")))
    cut = rows.select("word", "n", "size", "long", F.inline(two)).where("lo < hi")
    after = F.col("hi") + F.when(F.col("long"), 1).otherwise(0)
    rest = F.concat(F.substring("word", F.lit(1), F.col("lo")), F.substring("word", after, F.lit(1 << 30)))
    return cut.withColumn("rest", rest)


def _tagged(rows: DataFrame, most_pairs: int) -> DataFrame:
    """The rows of buckets in which two can meet; ``final`` where all pairs of the bucket may be made."""
    sizes = rows.groupBy(BUCKET).agg(F.sum(F.col("long").cast("long")).alias("n_long"), F.count(F.lit(1)).alias("n_rows"))
    sizes = sizes.where("n_long > 0 and n_rows > 1")
    final = (F.col("n_long") * F.col("n_rows") <= most_pairs) | (F.col("hi") - F.col("lo") == 1)
    return rows.join(stage(sizes.select(*BUCKET, final.alias("final")), "chunk-sizes"), BUCKET)


def _met(rows: DataFrame) -> DataFrame:
    """The near pairs of each bucket, both ways."""
    long = rows.where("long").select(*BUCKET, F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = rows.select(*BUCKET, "long", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = long.join(other, BUCKET).where((~F.col("long") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    ways = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    return met.select(F.inline(ways))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root): the end of the chain of forms that begins with each row (word, form).

    Chains end, as a form is more frequent than its word; their steps double in each round.
    """
    found = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stage(found.join(further, "root", "left"), "root-steps")
        if joined.where("next is not null").isEmpty():
            return found
        found = joined.select("word", F.coalesce("next", "root").alias("root"))


def counted_runs(
    docs: DataFrame, least_length: int, least_count: int, delete_every: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (word, n): letter runs of all texts, a part of them with one code point deleted.

    With h the crc32 of "<key>:<run in lower case>" a run that ``delete_every`` divides loses its
    code point h % length, so variants of known rate are among the words.  Runs shorter than
    ``least_length`` cannot become words and are passed over at once.  A null key is the text "".
    """
    pattern = F.lit(rf"[A-Za-zÀ-ÿ]{{{least_length},}}")
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, pattern, F.lit(0))).alias("run"))
    lower = runs.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    hashed = lower.select("run", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.lit(1 << 30)))
    word = F.when(F.col("h") % delete_every == 0, shorter).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.char_length("word") >= least_length).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
