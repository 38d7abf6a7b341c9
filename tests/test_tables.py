"""Stored tables: what versions write, and writers that collide."""

import glob

import pytest
from frames import rows

from martlet.session import fresh_path
from martlet.sources.tables import Tables, VersionConflict


def data_files(tables):
    return set(glob.glob(f"{tables.root}/t/**/*.parquet", recursive=True))


@pytest.fixture()
def tables(spark):
    return Tables(spark, fresh_path(spark, "warehouse"))


def test_insert_writes_only_new_rows(spark, tables):
    tables.replace("t", spark.range(5).selectExpr("id", "id * 2 AS twice"))
    before = data_files(tables)
    out = tables.insert("t", spark.createDataFrame([(9,)], "id long"))
    new = data_files(tables) - before
    assert before <= data_files(tables)
    assert spark.read.parquet(*sorted(new)).count() == 1
    assert rows(out) == rows(tables.read("t")) == [(0, 0), (1, 2), (2, 4), (3, 6), (4, 8), (9, None)]


def test_snapshot_truncate_and_restore_write_no_data(spark, tables):
    tables.replace("t", spark.range(5))
    tables.insert("t", spark.range(5, 8))
    before = data_files(tables)
    tables.snapshot("s", ["t"])
    tables.truncate("t")
    assert tables.read("t").count() == 0
    tables.insert("t", spark.range(100, 101))
    assert rows(tables.read("t")) == [(100,)]
    tables.restore("s", ["t"])
    assert rows(tables.read("t")) == [(i,) for i in range(8)]
    assert len(data_files(tables) - before) >= 1 and before <= data_files(tables)
    assert rows(tables.snapshots()) == [("s",)]
    assert [r.version for r in tables.versions().filter("snapshot IS NULL").orderBy("version").collect()] == [1, 2, 3, 4, 5]
    with pytest.raises(KeyError):
        tables.restore("s", ["other"])
    with pytest.raises(VersionConflict):
        tables.snapshot("s", ["t"])


def test_two_writers_on_one_version(spark, tables):
    tables.replace("t", spark.range(3))
    seen = tables._newest("t")
    other = Tables(spark, tables.root)
    other.insert("t", spark.range(3, 4))
    with pytest.raises(VersionConflict):  # it has read the version before
        tables._next("t", seen, ["nowhere"], seen["schema"])
    assert rows(tables.read("t")) == [(0,), (1,), (2,), (3,)]


def test_partitioned_versions(spark, tables):
    frame = spark.range(6).selectExpr("id", "id % 2 AS part")
    tables.replace("t", frame, ("part",))
    tables.insert("t", spark.createDataFrame([(7, 1)], "id long, part long"))
    assert rows(tables.read("t").select("id", "part")) == [(i, i % 2) for i in range(6)] + [(7, 1)]
