import random

import pytest
from pyspark.sql import functions as F

from haulmark.session import run_dir
from haulmark.sources.versioned import COMMIT, Part, Version, VersionedTable
from haulmark.streaming.keyed import KeyedStore, read_upserted, upsert_batch

KINDS = "id string, status string, km double, at int, offset int"


def files(spark, path):
    """Data files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/data").filter(F.col("path").endswith(".parquet")).count()


def test_replay_and_partial_rows(spark, rows):
    path = f"{run_dir(spark, 't-upsert')}/target"
    write = upsert_batch(path, ["id"], ["at", "offset"])
    write(spark.createDataFrame([("a", "Open", 5.0, 1, 0), ("b", "Open", 6.0, 1, 1)], KINDS), 0)
    second = spark.createDataFrame([("a", "Done", None, 3, 2), ("a", "Moving", None, 2, 3)], KINDS)
    for _ in range(2):  # the same batch after a failure
        write(second, 1)
    write(second.limit(0), 2)
    wanted = [("a", "Done", 5.0), ("b", "Open", 6.0)]
    assert rows(read_upserted(spark, path, ["id"])) == wanted
    KeyedStore.at(spark, path, ["id"]).fold()
    assert rows(read_upserted(spark, path, ["id"])) == wanted


def test_offset_breaks_ties_of_time(spark, rows):
    for status in (("InProgress", "Completed"), ("Completed", "InProgress")):
        path = f"{run_dir(spark, 't-tie')}/target"
        write = upsert_batch(path, ["id"], ["at", "offset"])
        messages = [("a", s, None, 5, offset) for offset, s in enumerate(status)]
        write(spark.createDataFrame(messages[::-1], KINDS), 0)
        assert rows(read_upserted(spark, path, ["id"]), "status") == [(status[1],)]


def test_result_does_not_depend_on_batch_borders(spark, rows):
    """Out of order, repeated and tied messages, split in several ways, with and without folds."""
    messages = [("a", "Done", None, 9, 1), ("a", "Open", 5.0, 1, 2), ("b", "Open", 1.0, 4, 3), ("b", "Late", 2.0, 4, 4),
                ("a", "Moving", 6.0, 3, 5), ("a", "Done", None, 9, 1), ("c", None, None, None, 6), (None, "x", 1.0, 1, 7)]
    results = []
    for n, splits in enumerate(([8], [1] * 8, [4, 4], [2, 2, 4])):
        for fold_every in (100, 2):
            path, at = f"{run_dir(spark, 't-split')}/target", 0
            write = upsert_batch(path, ["id"], ["at", "offset"], fold_every=fold_every, buckets=4)
            for batch_id, size in enumerate(splits):
                part = messages[at : at + size] if n % 2 else messages[::-1][at : at + size]
                write(spark.createDataFrame(part, KINDS), batch_id)
                at += size
            results.append(rows(read_upserted(spark, path, ["id"])))
    assert results == [sorted([("a", "Done", 6.0), ("b", "Late", 2.0), ("c", None, None), (None, "x", 1.0)], key=repr)] * 8


@pytest.mark.parametrize("moment", ["write", "publish"])
def test_a_fold_that_dies_changes_nothing(spark, rows, monkeypatch, moment):
    path = f"{run_dir(spark, 't-die')}/target"
    store = KeyedStore.at(spark, path, ["id"], fold_every=100, grace=0, buckets=4)
    for batch_id in range(3):
        store.upsert(spark.createDataFrame([(str(i), f"s{batch_id}", 1.0, batch_id, i) for i in range(20)], KINDS), ["at", "offset"], batch_id)
    before, version = rows(store.read()), store.table.current()

    def dies(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        if moment == "write":
            original = VersionedTable.write

            def half(self, df, by_bucket=False):
                original(self, df.limit(3), by_bucket)
                dies()

            m.setattr(VersionedTable, "write", half)
        else:
            m.setattr(VersionedTable, "change", dies)
        with pytest.raises(RuntimeError, match="killed"):
            store.fold()
    assert store.table.current() == version
    assert rows(store.read()) == before
    assert store.table.clean(grace=0) == 1  # what the dead writer left
    store.fold()
    assert rows(store.read()) == before
    assert len(store.table.current().parts) == 1


def test_a_reader_keeps_its_version(spark, rows):
    path = f"{run_dir(spark, 't-reader')}/target"
    store = KeyedStore.at(spark, path, ["id"], fold_every=2, buckets=2)
    store.upsert(spark.createDataFrame([("a", "old", 1.0, 1, 1)], KINDS), ["at", "offset"], 0)
    held = store.read()
    for batch_id in range(1, 5):
        store.upsert(spark.createDataFrame([("a", f"new{batch_id}", 1.0, 1 + batch_id, 1)], KINDS), ["at", "offset"], batch_id)
    assert rows(held, "status") == [("old",)]
    assert rows(store.read(), "status") == [("new4",)]


def test_a_fold_rewrites_only_its_buckets(spark):
    path = f"{run_dir(spark, 't-buckets')}/target"
    store = KeyedStore.at(spark, path, ["id"], fold_every=100, buckets=8)
    for batch_id in range(3):
        store.upsert(spark.createDataFrame([(str(i), "x", 1.0, batch_id, i) for i in range(100)], KINDS), ["at", "offset"], batch_id)
    store.fold((1, 5))
    parts = store.table.current().parts
    assert parts[0].buckets == (1, 5)
    assert [p.buckets for p in parts[1:]] == [(0, 2, 3, 4, 6, 7)] * 3
    plan = store.table.live()._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan
    assert spark.read.parquet(f"{path}/data/{COMMIT}={parts[0].commit}").select("_bucket").distinct().count() == 2


def test_the_store_stays_bounded(spark, rows):
    path = f"{run_dir(spark, 't-bounded')}/target"
    store = KeyedStore.at(spark, path, ["id"], fold_every=4, buckets=4, grace=0)
    rng, latest, sizes = random.Random(2), {}, []
    for batch_id in range(64):
        part = [(str(rng.randrange(30)), f"s{batch_id}", None, batch_id, i) for i in range(5)]
        for key, status, _, at, offset in part:
            latest[key] = status
        store.upsert(spark.createDataFrame(part, KINDS).coalesce(1), ["at", "offset"], batch_id)
        if batch_id % 16 == 15:
            sizes.append(files(spark, path))
    assert rows(store.read(), "id", "status") == sorted(latest.items(), key=repr)
    assert max(sizes) <= 4 * (4 + 3) * 2
    assert len(store.table.current().parts) <= 2 * 4 + 4
    assert len(store.table._numbers()) <= 2 * 4 + 2


def test_before_the_first_batch(spark):
    like = spark.createDataFrame([], "id int, v int")
    path = f"{run_dir(spark, 't-none')}/target"
    assert read_upserted(spark, path, ["id"], like).schema == like.schema
    with pytest.raises(ValueError, match="nothing has been written"):
        read_upserted(spark, path, ["id"])


def test_appends_and_clears_happen_once_for_each_run(spark, rows):
    table = VersionedTable(spark, f"{run_dir(spark, 't-append')}/t")
    a, b = (spark.createDataFrame([(x,)], "v string") for x in "ab")
    assert table.append(a, "monday") and not table.append(a, "monday")
    assert table.append(b, "tuesday")
    assert rows(table.read()) == [("a",), ("b",)]
    assert table.replace(a.limit(0), "clear-1")
    assert not table.replace(a.limit(0), "clear-1") and not table.append(b, "tuesday")
    # another session reads the cleared table
    assert VersionedTable(spark.newSession(), table.root).read().count() == 0
    assert table.append(b, "wednesday")
    assert rows(table.read()) == [("b",)]


def test_of_two_writers_none_is_lost(spark, rows):
    table = VersionedTable(spark, f"{run_dir(spark, 't-race')}/t")
    table.append(spark.createDataFrame([("first",)], "v string"), "1")
    other, raced = VersionedTable(spark, table.root), []
    publish = table.files.publish

    def late(name, text):
        if not raced:
            raced.append(other.append(spark.createDataFrame([("other",)], "v string"), "2"))
        return publish(name, text)

    table.files.publish = late
    assert table.append(spark.createDataFrame([("mine",)], "v string"), "3")
    assert raced == [True]
    assert rows(table.read()) == [("first",), ("mine",), ("other",)]


def test_compaction_and_cleaning(spark, rows):
    table = VersionedTable(spark, f"{run_dir(spark, 't-compact')}/t")
    for i in range(5):
        table.append(spark.createDataFrame([(str(i),)], "v string"), f"r{i}")
    before = rows(table.read())
    table.compact()
    assert rows(table.read()) == before
    assert len(table.current().parts) == 1 and not table.append(spark.createDataFrame([("x",)], "v string"), "r3")
    assert table.clean(grace=3600) == 0
    assert table.clean(grace=0) == 5
    assert rows(table.read()) == before and len(table._numbers()) == 1


def test_manifest_round_trip():
    version = Version(3, "{}", (Part("c", "r", (1, 2)), Part("d", "s")), ("old",), 7)
    assert Version.of(3, version.to_json()) == version
