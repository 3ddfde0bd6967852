from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from estatelake import folders
from estatelake.operators.merging import merge_by_key, merge_newest, union_parts
from estatelake.sources.silver import DuplicateKeys, SilverTable

OLD = [("a", 1.0, "x"), ("b", 2.0, "y"), ("c", 3.0, None)]
NEW = [("b", None, True), ("d", 4.0, False)]
MERGED = {("a", 1.0, "x", None), ("b", None, "y", True), ("c", 3.0, None, None), ("d", 4.0, None, False)}


def test_batch_wins_with_nulls_and_missing_columns_survive(spark):
    old = spark.createDataFrame(OLD, "id string, price double, note string")
    new = spark.createDataFrame(NEW, "id string, price double, lift boolean")
    merged = merge_by_key(old, new, ["id"])
    assert {tuple(r) for r in merged.select("id", "price", "note", "lift").collect()} == MERGED


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_table_versions(spark, tmp_path, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        table = SilverTable(spark, str(tmp_path / "t"), ["id"])
        assert not table.exists()
        first = spark.createDataFrame(
            [("a", 1, 1), ("a", 2, 2), (None, 9, 1)], "id string, v int, seq int"
        )
        table.upsert(first, [F.desc("seq")])
        second = spark.createDataFrame([("a", 5, 3), ("b", 6, 1)], "id string, v int, seq int")
        table.upsert(second, [F.desc("seq")])
        once = sorted(tuple(r) for r in table.read().collect())
        table.upsert(second, [F.desc("seq")])
        assert once == sorted(tuple(r) for r in table.read().collect()) == [("a", 5, 3), ("b", 6, 1)]
        assert table.versions() == [1, 2, 3] and table.duplicates().count() == 0
        assert table.read_rejected().count() == 1
        late = spark.createDataFrame([("a", 4, 2), ("c", 7, 1)], "id string, v int, seq int")
        table.upsert(late, [F.desc("seq")])
        assert sorted(tuple(r) for r in table.read().collect()) == [*once, ("c", 7, 1)]
        table.prune(keep=1)
        assert sorted(tuple(r) for r in table.read().collect()) == [*once, ("c", 7, 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unfinished_attempts_are_not_read_and_stay(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    table.publish(spark.range(3).toDF("id"))
    running = tmp_path / "t" / "attempt=other" / "bucket=1"
    running.mkdir(parents=True)
    assert table.read().count() == 3
    table.publish(spark.range(5).toDF("id"))
    assert table.versions() == [1, 2] and table.read().count() == 5 and running.exists()
    assert table.read(version=1).count() >= 3 and not [p for p in (tmp_path / "t" / "commits").iterdir() if not p.name.isdigit()]


def test_upsert_writes_only_touched_buckets(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    table.upsert(spark.range(500).selectExpr("id", "id as v"))
    table.upsert(spark.createDataFrame([(3, 30)], "id long, v long"))
    written = tmp_path / "t" / f"attempt={table.state().attempt}"
    assert len([p for p in written.iterdir() if p.name.startswith("bucket=")]) == 1
    found = {r["id"]: r["v"] for r in table.read().collect()}
    assert found == {i: i for i in range(500)} | {3: 30}
    old = {r["id"]: r["v"] for r in table.read(version=1).collect()}
    assert old == {i: i for i in range(500)}


class Interrupted(SilverTable):
    """Another writer commits just before the first commit of this one."""

    other = None

    def _commit(self, state, attempt, source):
        if self.other is not None:
            other, self.other = self.other, None
            other()
        return super()._commit(state, attempt, source)


@pytest.mark.parametrize(("theirs", "again"), [([("a", 5), ("c", 6)], True), ([("z", 7)], False)])
def test_two_interleaved_upserts_lose_no_row(spark, tmp_path, theirs, again):
    first = SilverTable(spark, str(tmp_path / "t"), ["id"])
    first.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int"))
    mine = Interrupted(spark, str(tmp_path / "t"), ["id"])
    mine.other = lambda: first.upsert(spark.createDataFrame(theirs, "id string, v int"))
    merges = []
    merge = mine._merge
    mine._merge = lambda *args: merges.append(1) or merge(*args)
    assert mine.upsert(spark.createDataFrame([("a", 9), ("d", 9)], "id string, v int")) == 3
    assert {tuple(r) for r in mine.read().collect()} == {("b", 1)} | {t for t in theirs if t[0] != "a"} | {("a", 9), ("d", 9)}
    assert len(merges) == (2 if again else 1)


def test_many_writers_at_once(spark, tmp_path):
    def write(n):
        table = SilverTable(spark, str(tmp_path / "t"), ["id"])
        return table.upsert(spark.range(n, 200, 5).selectExpr("id", f"{n} as v"))

    with ThreadPoolExecutor(5) as pool:
        assert sorted(pool.map(write, range(5))) == [1, 2, 3, 4, 5]
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    assert {r["id"]: r["v"] for r in table.read().collect()} == {i: i % 5 for i in range(200)}
    table.prune(keep=1)
    assert table.read().count() == 200


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    batch = spark.createDataFrame([("a", 1), (None, 2)], "id string, v int")
    assert [table.upsert(batch, source=("stream", 0)), table.upsert(batch, source=("stream", 0))] == [1, 1]
    assert table.upsert(batch, source=("other stream", 0)) == 2
    assert table.upsert(batch, source=("stream", 1)) == 3
    assert table.read_rejected().count() == 3 and table.read().count() == 1
    assert table.upsert(batch, source=("stream", 0)) == 3


def test_a_repeated_batch_of_a_stream_counts_its_rejected_rows_once(spark, tmp_path):
    from estatelake.streaming import upsert as upsert_plan

    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "id string, v int")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        upsert_plan.upsert(stream, table, [F.desc("v")], str(tmp_path / "cp")).awaitTermination()

    run()
    # The stream forgets that it ended its batch, as after a failure just before it could note it.
    for name in ("commits/0", "commits/.0.crc"):
        (tmp_path / "cp" / name).unlink()
    run()
    assert table.versions() == [1] and table.read_rejected().count() == 2


def test_a_unique_table_refuses_a_batch_that_repeats_a_key(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["id"], unique=True)
    table.upsert(spark.createDataFrame([("a", 1)], "id string, v int"))
    twice = spark.createDataFrame([("b", 1), ("b", 2), ("a", 3)], "id string, v int")
    with pytest.raises(DuplicateKeys):
        table.upsert(twice)
    assert table.versions() == [1] and [tuple(r) for r in table.read().collect()] == [("a", 1)]
    assert len(list((tmp_path / "t").glob("attempt=*"))) == 1
    assert table.upsert(twice, [F.desc("v")]) == 2
    assert {tuple(r) for r in table.read().collect()} == {("a", 3), ("b", 2)}


def test_a_marker_is_created_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "commits" / "1")
    assert folders.create_if_absent(spark, path, "é") and not folders.create_if_absent(spark, path, "b")
    monkeypatch.setattr(folders, "_claim", lambda spark, system, draft, target: folders.rename_absent(spark, draft, target))
    assert not folders.create_if_absent(spark, path, "c") and folders.create_if_absent(spark, path + "1", "d")
    assert [folders.read_text(spark, p) for p in (path, path + "1")] == ["é", "d"]
    assert sorted(folders.folder_names(spark, str(tmp_path / "commits"))) == ["1", "11"]


def test_newest_of_two_batches_wins_in_any_order(spark, tmp_path):
    early = spark.createDataFrame([("a", 1, 1, "x"), (None, 2, 1, "y")], "id string, v int, seq int, note string")
    late = spark.createDataFrame([("a", None, 2), ("b", 3, 2)], "id string, v int, seq int")
    wanted = {("a", None, 2, "x"), ("b", 3, 2, None)}
    for name, batches in (("one", [early, late]), ("two", [late, early])):
        table = SilverTable(spark, str(tmp_path / name), ["id"])
        for batch in batches:
            table.upsert(batch, [F.desc("seq")])
        assert {tuple(r) for r in table.read().select("id", "v", "seq", "note").collect()} == wanted


def test_union_by_name(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2)], "b string, a int")
    assert sorted(tuple(r) for r in union_parts([left, right]).collect()) == [(1, "x"), (2, "y")]


def test_writers_of_one_process_never_merge_in_vain(spark, tmp_path):
    merges = []

    class Counted(SilverTable):
        def _merge(self, *args):
            merges.append(1)
            return super()._merge(*args)

    def write(n):
        table = Counted(spark, str(tmp_path / "t"), ["id"], unique=True)
        for v in (n, n + 10):
            table.upsert(spark.range(40).selectExpr("id", f"{v} as v"), [F.desc("v")])

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    assert len(merges) == 6 and {tuple(r) for r in table.read().collect()} == {(i, 12) for i in range(40)}


def test_rows_of_equal_columns_are_merged_in_one_shuffle(spark, tmp_path):
    spark.createDataFrame([("a", 1, 1), ("b", 2, 5), ("c", 3, 1)], "id string, v int, seq int").write.parquet(str(tmp_path / "old"))
    spark.createDataFrame([(7, "a", 2), (8, "a", 3), (9, "b", 4), (6, "c", 1)], "v int, id string, seq int").write.parquet(str(tmp_path / "new"))
    merged = merge_newest(spark.read.parquet(str(tmp_path / "old")), spark.read.parquet(str(tmp_path / "new")), ["id"], [F.desc("seq")])
    assert merged.columns == ["id", "v", "seq"]
    assert {tuple(r) for r in merged.collect()} == {("a", 8, 3), ("b", 2, 5), ("c", 6, 1)}
    assert merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


def test_a_written_batch_is_not_written_again(spark, tmp_path):
    rows = spark.range(30).selectExpr("id % 10 as id", "id as v")
    rows.write.parquet(str(tmp_path / "in"))
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    table.upsert(spark.read.parquet(str(tmp_path / "in")), [F.desc("v")], written=True)
    assert {tuple(r) for r in table.read().collect()} == {(i, 20 + i) for i in range(10)}


class Planned(SilverTable):
    """Keeps the plan of its last merge."""

    def _merge(self, *args):
        merged = super()._merge(*args)
        self.plan = merged._jdf.queryExecution().executedPlan().toString()
        return merged


def test_rows_of_other_columns_are_merged_in_one_shuffle(spark, tmp_path):
    table = Planned(spark, str(tmp_path / "t"), ["id"])
    table.upsert(spark.createDataFrame([("a", 1, 5, "x"), ("b", 2, 1, "y"), ("c", 3, 1, None)], "id string, v int, seq int, note string"), [F.desc("seq")])
    # Of "a" the table has the newest copy, of "b" the batch; "d" and "e" are new, "b" and "e" come several times.
    late = [("a", 9, 4, True), ("b", 4, 3, False), ("b", 5, 2, True), ("b", 6, 1, True), ("d", 7, 1, None), ("e", 8, 1, False), ("e", 8, 2, True), ("e", 8, 0, None)]
    table.upsert(spark.createDataFrame(late, "id string, v int, seq int, lift boolean"), [F.desc("seq")])
    assert table.plan.count("Exchange hashpartitioning") == 1
    # Copies that cannot count are left out before the shuffle.
    assert table.plan.index("Exchange hashpartitioning") < table.plan.rindex("WindowGroupLimit") and "Partial" in table.plan
    wanted = {("a", 1, 5, "x", True), ("b", 4, 3, "y", False), ("c", 3, 1, None, None), ("d", 7, 1, None, None), ("e", 8, 2, None, True)}
    assert {tuple(r) for r in table.read().select("id", "v", "seq", "note", "lift").collect()} == wanted


@pytest.mark.parametrize("published", [True, False])
def test_keys_that_a_plain_table_repeats_hide_no_row_of_a_batch(spark, tmp_path, published):
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    twice = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 2, "y"), ("a", 3, 3, "z"), ("b", 1, 1, "w")], "id string, v int, seq int, note string")
    table.publish(twice) if published else table.upsert(twice)
    if not published:
        table.upsert(spark.createDataFrame([("f", 1, 1, None)], twice.schema), [F.desc("seq")])
    table.upsert(spark.createDataFrame([("a", 7, 9, True), ("a", 6, 8, False)], "id string, v int, seq int, lift boolean"), [F.desc("seq")])
    rows = {tuple(r) for r in table.read().where("id < 'f'").select("id", "v", "seq", "note", "lift").collect()}
    assert rows == {("a", 7, 9, "z", True), ("b", 1, 1, "w", None)}


def test_a_marker_says_whether_keys_may_repeat(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "id string, v int")
    for name, unique, wanted in (("plain", False, [False, True, True]), ("unique", True, [False, False, False])):
        table = SilverTable(spark, str(tmp_path / name), ["id"], unique=unique)
        table.upsert(rows, [F.desc("v")])
        table.publish(rows)
        table.upsert(rows, [F.desc("v")])
        assert [table.state(v).repeats for v in table.versions()] == wanted
    (tmp_path / "plain" / "commits" / "00000004").write_text('{"attempt": "x", "buckets": {}, "applied": {}}')
    assert SilverTable(spark, str(tmp_path / "plain"), ["id"]).state().repeats


def test_versions_are_packed(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["id"])
    table.upsert(spark.range(20).selectExpr("nullif(id, 3) as id", "id as v"), [F.desc("v")])
    for folder in (f"attempt={table.state().attempt}", "rejected"):
        assert list((tmp_path / "t" / folder).rglob("*.zstd.parquet"))
