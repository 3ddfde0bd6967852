"""Versioned silver tables with keyed upsert, for any number of writers.

Rows are dealt to ``BUCKETS`` folders by a hash of their key.  A writer puts the buckets that
it changes into a folder of its own (``attempt=...``) and then commits: it creates the
marker of the next version, which must not exist yet.  A marker holds the table's whole
state: the attempt that has each bucket, the last batch that each stream has applied, and whether keys may repeat.
Readers take the newest marker, so they see a version whole or not at all, whatever
writers fail or still write, and no path being read is rewritten.

Of two writers of one version one loses.  It takes the winner's state: if that left its
buckets as they were it commits what it wrote as the version after, else it merges again.
So no row of either is lost, and nothing that another writer wrote is deleted.  Writers of
one process take turns, so that none of them merges in vain; a process that dies holds nobody up.
"""

from __future__ import annotations

import json
import threading
import uuid
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.folders import create_if_absent, folder_names, read_text, remove_folder
from estatelake.operators.cleaning import duplicate_keys, latest_per_key, split_null_keys
from estatelake.operators.merging import merge_by_key, merge_newest, union_parts
from estatelake.staging import staged

BUCKET = "bucket"
BUCKETS = 64
# A version is written once and read for long, so its rows are packed tightly.
PACKED = {"compression": "zstd"}
# How often a writer that loses a version tries the next one.
ATTEMPTS = 20
# Of each table, whose turn it is among this process's writers; a commit may itself call another writer.
_turns: dict[str, threading.RLock] = {}


class DuplicateKeys(ValueError):
    """A commit would have left a key twice in a table of unique keys."""


class LostCommit(RuntimeError):
    """Other writers took every version that this one tried."""


@dataclass
class State:
    """What a marker says."""

    version: int = 0
    # The attempt that made this version, and the one whose columns are the table's.
    attempt: str = ""
    buckets: dict[int, str] = field(default_factory=dict)
    # By stream, the last batch that is in the table.
    applied: dict[str, int] = field(default_factory=dict)
    # Whether a key may occur more than once.
    repeats: bool = False

    def text(self) -> str:
        said = {"attempt": self.attempt, "buckets": self.buckets, "applied": self.applied, "repeats": self.repeats}
        return json.dumps(said)


class SilverTable:
    """One keyed silver entity under a path; with ``unique``, a commit that repeats a key is refused."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], unique: bool = False):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = keys
        self.unique = unique

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(int(n) for n in folder_names(self.spark, f"{self.path}/commits") if n.isdigit())

    def exists(self) -> bool:
        return bool(self.versions())

    def state(self, version: int | None = None) -> State:
        """The state of a version, the newest one if none is named; empty without any."""
        versions = self.versions()
        if version is None and not versions:
            return State()
        number = versions[-1] if version is None else version
        found = json.loads(read_text(self.spark, self._marker(number)))
        buckets = {int(b): attempt for b, attempt in found["buckets"].items()}
        return State(number, found["attempt"], buckets, found["applied"], found.get("repeats", True))

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """All rows, or those of some buckets, of the newest or of a named version."""
        return self._rows(self.state(version), buckets)

    def read_rejected(self) -> DataFrame:
        """The rows without a key of all batches that are in the table."""
        attempts = [self.state(v).attempt for v in self.versions()]
        written = set(folder_names(self.spark, f"{self.path}/rejected"))
        parts = [f"{self.path}/rejected/attempt={a}" for a in attempts if f"attempt={a}" in written]
        return union_parts([self.spark.read.parquet(p) for p in parts])

    def publish(self, df: DataFrame) -> int:
        """Write the rows as a new version of the buckets that they are in."""
        attempt = self._write(df)
        for _ in range(ATTEMPTS):
            state = self.state()
            state.repeats |= not self.unique
            if self._commit(state, attempt, None):
                return state.version + 1
        raise self._lost(attempt)

    def upsert(
        self,
        batch: DataFrame,
        newest_first: list[Column] | None = None,
        source: tuple[str, int] | None = None,
        written: bool = False,
    ) -> int:
        """Merge a batch by key into a new version.

        With an order given, the newest copy of a key stays, whether the table or the
        batch has it, so the order of batches does not matter; the table keeps the
        columns of the order.  Without one the batch wins.  Rows with a null key go to
        ``rejected`` beside the versions.  A batch that names its ``source`` (stream and
        rising batch number) is applied once: merged again, it changes nothing and adds no version.
        A batch is read more than once, so it is staged, unless it is ``written``: a table on storage, or rows of one.
        """
        turn = _turns.setdefault(self.path, threading.RLock())
        with nullcontext(batch) if written else staged(batch, "upsert-batch") as rows, turn:
            whole, rejected = split_null_keys(rows, self.keys)
            touched = [r[0] for r in whole.select(self._bucket()).distinct().collect()]
            attempt, base = None, None
            for _ in range(ATTEMPTS):
                state = self.state()
                if source is not None and state.applied.get(source[0], -1) >= source[1]:
                    if attempt is not None:
                        self._discard(attempt)
                    return state.version
                own = {b: state.buckets.get(b) for b in touched}
                if own != base:
                    if attempt is not None:
                        self._discard(attempt)
                    merged = self._merge(state, whole, touched, newest_first)
                    attempt, base = self._write(merged, rejected, ranked=newest_first is not None), own
                state.repeats |= newest_first is None and not self.unique
                if self._commit(state, attempt, source):
                    return state.version + 1
            raise self._lost(attempt)

    def duplicates(self) -> DataFrame:
        """Keys that occur more than once; reported, never deleted."""
        return duplicate_keys(self.read(), self.keys)

    def prune(self, keep: int = 2) -> None:
        """Delete the buckets of older versions that the last ``keep`` versions do not use."""
        versions = self.versions()
        used = {(attempt, b) for v in versions[-keep:] for b, attempt in self.state(v).buckets.items()}
        for version in versions[:-keep]:
            attempt = self.state(version).attempt
            for b in self._buckets(attempt):
                if (attempt, b) not in used:
                    remove_folder(self.spark, f"{self._folder(attempt)}/{BUCKET}={b}")

    def _rows(self, state: State, buckets: list[int] | None) -> DataFrame:
        if not state.version:
            raise FileNotFoundError(f"no committed version under {self.path}")
        by_attempt: dict[str, list[str]] = {}
        for b, attempt in sorted(state.buckets.items()):
            if buckets is None or b in buckets:
                by_attempt.setdefault(attempt, []).append(f"{self._folder(attempt)}/{BUCKET}={b}")
        columns = self.spark.read.parquet(self._schema_folder(state.attempt))
        return union_parts([columns, *[self.spark.read.parquet(*paths) for paths in by_attempt.values()]])

    def _merge(self, state: State, batch: DataFrame, touched: list[int], newest_first: list[Column] | None) -> DataFrame:
        if not state.version:
            return batch if newest_first is None else latest_per_key(batch, self.keys, newest_first)
        current = self._rows(state, touched)
        if newest_first is None:
            return merge_by_key(current, batch, self.keys)
        return merge_newest(current, batch, self.keys, newest_first, unique=not state.repeats)

    def _write(self, df: DataFrame, rejected: DataFrame | None = None, ranked: bool = False) -> str:
        """The rows in an attempt of their own, which no reader sees yet.

        ``ranked`` rows come out of a shuffle by key that kept one for each key: they are neither
        shuffled again, as tasks of a usual size give files of a usual size for each bucket, nor counted by key.
        """
        attempt = uuid.uuid4().hex
        if rejected is not None:
            rejected.write.options(**PACKED).parquet(f"{self.path}/rejected/attempt={attempt}")
        df.limit(0).write.parquet(self._schema_folder(attempt))
        dealt = df.withColumn(BUCKET, self._bucket())
        if not ranked:
            dealt = dealt.hint("rebalance", F.col(BUCKET))
        dealt.write.options(**PACKED).partitionBy(BUCKET).parquet(self._folder(attempt))
        if self.unique and not ranked and self._buckets(attempt):
            written = self.spark.read.parquet(self._folder(attempt))
            twice = duplicate_keys(written, self.keys).first()
            if twice is not None:
                self._discard(attempt)
                raise DuplicateKeys(f"{dict(zip(self.keys, twice))} occurs more than once in {self.path}")
        return attempt

    def _commit(self, state: State, attempt: str, source: tuple[str, int] | None) -> bool:
        buckets = state.buckets | dict.fromkeys(self._buckets(attempt), attempt)
        applied = state.applied | ({source[0]: source[1]} if source is not None else {})
        number = state.version + 1
        return create_if_absent(self.spark, self._marker(number), State(number, attempt, buckets, applied, state.repeats).text())

    def _discard(self, attempt: str) -> None:
        """Delete an own attempt that is in no version."""
        for folder in (self._folder(attempt), self._schema_folder(attempt), f"{self.path}/rejected/attempt={attempt}"):
            remove_folder(self.spark, folder)

    def _lost(self, attempt: str) -> LostCommit:
        self._discard(attempt)
        return LostCommit(f"{ATTEMPTS} versions of {self.path} went to other writers")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def _buckets(self, attempt: str) -> list[int]:
        start = f"{BUCKET}="
        return [int(n[len(start):]) for n in folder_names(self.spark, self._folder(attempt)) if n.startswith(start)]

    def _marker(self, number: int) -> str:
        return f"{self.path}/commits/{number:08d}"

    def _schema_folder(self, attempt: str) -> str:
        return f"{self.path}/columns/attempt={attempt}"

    def _folder(self, attempt: str) -> str:
        return f"{self.path}/attempt={attempt}"
