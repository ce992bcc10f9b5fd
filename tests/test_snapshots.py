import time

import pytest
from pyspark.sql import functions as F

from books import rows
from coffer.sinks.snapshots import (
    CLEANUP,
    MARKER,
    append_snapshot,
    compact_snapshot,
    current_versions,
    expire_snapshots,
    latest_version,
    layer_path,
    read_snapshot,
    stored_parts,
    version_path,
    versions,
    write_clients,
    write_snapshot,
)
from coffer.sinks.views import register_views
from coffer.sources.catalog import table_exists


def frame(spark, *data):
    return spark.createDataFrame(list(data), "client string, n int, t timestamp_ntz, a array<string>")


def test_versions_replace_and_keep_types(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert read_snapshot(spark, path) is None
    assert write_snapshot(frame(spark, ("007", 1, None, ["x"])), path) == 1
    first = read_snapshot(spark, path)
    assert write_snapshot(first.withColumn("n", F.col("n") + 1), path) == 2
    assert rows(read_snapshot(spark, path), "client", "n") == [("007", 2)]
    assert rows(first, "client", "n") == [("007", 1)]
    assert read_snapshot(spark, path).schema == first.schema == frame(spark).schema


def test_empty_table_keeps_its_schema(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(frame(spark), path)
    assert read_snapshot(spark, path).count() == 0
    assert read_snapshot(spark, path).schema == frame(spark).schema


def test_unfinished_version_is_invisible(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(frame(spark, ("c", 1, None, None)), path)
    frame(spark, ("c", 2, None, None)).write.parquet(version_path(path, 2))
    assert versions(spark, path) == [1] and latest_version(spark, path) == 1
    assert write_snapshot(frame(spark, ("c", 3, None, None)), path) == 3
    assert rows(read_snapshot(spark, path), "n") == [(3,)]


def test_expiry(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(4):
        write_snapshot(frame(spark, ("c", n, None, None)), path)
    assert expire_snapshots(spark, path, keep=2) == [1, 2]
    assert versions(spark, path) == [3, 4]
    assert expire_snapshots(spark, path, keep=2) == []


def files(path):
    """Data files under a path with the time they were written."""
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_one_client_is_replaced_and_the_others_stay(spark, tmp_path):
    path, plain = f"{tmp_path}/t", lambda *data: frame(spark, *[(c, n, None, None) for c, n in data])
    write_snapshot(plain(("c", 1), ("d", 2), (None, 3), ("e/f g", 4)), path)
    first, before = read_snapshot(spark, path), files(tmp_path)
    assert write_clients(plain(("c", 10), ("c", 11)), path, ["c"]) == 2
    assert rows(read_snapshot(spark, path), "client", "n") == [(None, 3), ("c", 10), ("c", 11), ("d", 2), ("e/f g", 4)]
    after = files(tmp_path)
    assert before.items() <= after.items() and len(after) - len(before) in (1, 2)
    assert all("version=00000002/client=c/" in name for name in after.keys() - before.keys())
    # Another client, the one without a name, one that has no rows any more, and a new one.
    assert write_clients(plain((None, 30), ("g", 5)), path, [None, "g", "d"]) == 3
    assert rows(read_snapshot(spark, path), "client", "n") == [(None, 30), ("c", 10), ("c", 11), ("e/f g", 4), ("g", 5)]
    assert rows(current_versions(spark, path)) == [(None, 3), ("c", 2), ("d", 3), ("e/f g", 1), ("g", 3)]
    # Earlier versions can still be read, by number and by a frame made before.
    assert rows(first, "n") == rows(read_snapshot(spark, path, 1), "n") == [(1,), (2,), (3,), (4,)]
    assert rows(read_snapshot(spark, path, 2), "n") == [(10,), (11,), (2,), (3,), (4,)]


def test_replaced_clients_are_partition_filters(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(frame(spark, ("c", 1, None, None), ("d", 2, None, None)), path)
    write_clients(frame(spark, ("c", 3, None, None)), path, ["c"])
    plan = read_snapshot(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "version" in plan.split("PartitionFilters")[1]
    assert "DataFilters: []" in plan


def test_changed_columns_need_a_whole_replacement(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(frame(spark, ("c", 1, None, None), ("d", 2, None, None)), path)
    changed = frame(spark, ("c", 3, None, None)).withColumn("n", F.col("n").cast("long"))
    with pytest.raises(ValueError, match="replace the whole table"):
        write_clients(changed, path, ["c"])
    assert write_snapshot(changed, path) == 2
    assert rows(read_snapshot(spark, path), "client", "n") == [("c", 3)]


def test_first_write_and_empty_write_of_clients(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert write_clients(frame(spark, ("c", 1, None, None)), path, ["c"]) == 1
    assert write_clients(frame(spark), path, ["c"]) == 2
    assert read_snapshot(spark, path).count() == 0
    assert current_versions(spark, f"{tmp_path}/none").count() == 0


def test_appends_keep_what_is_stored(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(3):
        append_snapshot(frame(spark, ("c", n, None, None)), path)
    assert rows(read_snapshot(spark, path), "n") == [(0,), (1,), (2,)]
    assert rows(read_snapshot(spark, path, 2), "n") == [(0,), (1,)]
    assert all("version=" in f and f.count("part-") == 1 for f in files(tmp_path)) and len(files(tmp_path)) == 3
    assert compact_snapshot(spark, path) == 4 == compact_snapshot(spark, path)
    assert rows(read_snapshot(spark, path), "n") == [(0,), (1,), (2,)] and stored_parts(spark, path) == {4: None}


def test_expiry_keeps_what_is_pointed_to(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(frame(spark, ("c", 1, None, None), ("d", 2, None, None), (None, 3, None, None)), path)
    write_clients(frame(spark, ("c", 4, None, None)), path, ["c"])
    write_clients(frame(spark, ("c", 5, None, None)), path, ["c"])
    assert expire_snapshots(spark, path, keep=1) == [1, 2]
    assert versions(spark, path) == [3] and versions(spark, path, complete=False) == [1, 3]
    assert rows(read_snapshot(spark, path), "client", "n") == [(None, 3), ("c", 5), ("d", 2)]
    assert not any("version=00000001/client=c/" in name for name in files(tmp_path))
    assert write_clients(frame(spark, ("d", 6, None, None), (None, 7, None, None)), path, ["d", None]) == 4
    assert expire_snapshots(spark, path, keep=1) == [3]
    assert versions(spark, path, complete=False) == [3, 4]
    assert rows(read_snapshot(spark, path), "client", "n") == [(None, 7), ("c", 5), ("d", 6)]


def test_partitioned_by_client(spark, tmp_path):
    path = layer_path(str(tmp_path), "marts", "t")
    write_snapshot(frame(spark, ("c", 1, None, None), ("d", 2, None, None)), path)
    stored = tmp_path / "layer=marts" / "t" / "version=00000001"
    assert {p.name for p in stored.glob("client=*")} == {"client=c", "client=d"}
    assert (stored / MARKER).exists()
    plan = read_snapshot(spark, path).filter("client = 'c'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(client" in plan
    with pytest.raises(ValueError):
        layer_path(str(tmp_path), "attic", "t")


def test_existence_and_views(spark, tmp_path):
    assert not table_exists(spark, f"{tmp_path}/none")
    assert table_exists(spark, str(tmp_path))
    assert not table_exists(spark, "no_such_view")
    assert register_views({"seen": frame(spark)}, prefix="test_") == ["test_seen"]
    assert table_exists(spark, "test_seen")


def test_rows_of_few_clients_are_not_dealt_out_again(spark, tmp_path, monkeypatch):
    from coffer.sinks import snapshots

    plans, write = [], snapshots._write_rows

    def watched(df, path, partition_by):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, path, partition_by)

    monkeypatch.setattr(snapshots, "_write_rows", watched)
    df = spark.createDataFrame([(f"c{i}", i) for i in range(20)], "client string, n int")
    clients = [f"c{i}" for i in range(20)]
    snapshots.write_clients(df.filter("n < 2"), str(tmp_path / "t"), clients[:2])
    snapshots.write_clients(df, str(tmp_path / "t"), clients)
    snapshots.write_snapshot(df, str(tmp_path / "u"), even=False)
    assert ["RebalancePartitions" in p for p in plans] == [False, True, False]
    assert snapshots.read_snapshot(spark, str(tmp_path / "t")).count() == 20
    assert snapshots.read_snapshot(spark, str(tmp_path / "u")).count() == 20


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """What its job shuffled goes once the table is there, and the session's setting is as before."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def kept():
        return {n for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())
                if (n := f.getName()).startswith("shuffle_")}

    setting = spark.conf.get(CLEANUP, None)
    before = kept()
    write_snapshot(spark.range(1000).selectExpr("'c' AS client", "id % 7 AS k").groupBy("client", "k").count(), f"{tmp_path}/t")
    until = time.time() + 20
    while kept() - before and time.time() < until:
        time.sleep(0.2)
    assert not kept() - before
    assert spark.conf.get(CLEANUP, None) == setting
    assert read_snapshot(spark, f"{tmp_path}/t").count() == 7
