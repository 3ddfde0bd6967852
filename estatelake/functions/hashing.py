"""Content hashes as numbers: splits, samples, folds and fingerprints.

All are functions of the row content only, so they survive repartitioning and
re-execution, which ``rand`` and ``randomSplit`` do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: null marker of the row text that is hashed.
NULL_TEXT = "~"


def hash_number(text: Column, digits: int) -> Column:
    """The first ``digits`` hex digits of md5 as a bigint (15 digits at most)."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, digits), 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """Bucket 0..buckets-1 of a key; another salt gives an independent draw."""
    text = F.concat(F.lit(salt), key.cast("string")) if salt else key
    return (hash_number(text, 8) % F.lit(buckets)).cast("int")


def row_text(columns: list[Column]) -> Column:
    """The values of a row as one text that no other row has.

    Each value comes after its length and a colon, so a text cannot run into the next
    one; a null is the marker alone, which no length begins with.
    """
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_TEXT)) for t in texts]
    return F.concat(*fields)
