"""The index from key to day: what an upsert reads, and what it survives."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from ridelake.sources import key_days, tables

SCHEMA = "id INT, v STRING, created_at TIMESTAMP"


def batch(spark, items):
    return spark.createDataFrame([(i, v, dt.datetime.fromisoformat(f"2024-01-{d:02d}") if d else None) for i, v, d in items], SCHEMA)


def stored(spark, path):
    return sorted((r.id, r.v, r.day.day if r.day else None) for r in spark.read.parquet(path).collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.upsert_table(batch(spark, [(i, "a", 1 + i % 5) for i in range(40)]), path, "created_at") == "created"
    return path


def spoil(path, day):
    for file in glob.glob(f"{path}/day=2024-01-{day:02d}/*.parquet"):
        with open(file, "wb") as out:
            out.write(b"neither footer nor keys")
    for crc in glob.glob(f"{path}/day=2024-01-{day:02d}/.*.crc"):
        with open(crc, "wb") as out:
            out.write(b"")


def test_files_of_other_days_are_not_opened(spark, table):
    spoil(table, 4)  # ids with i % 5 == 3
    spoil(table, 5)
    assert tables.upsert_table(batch(spark, [(0, "b", 2), (77, "new", 6)]), table, "created_at") == "merged"
    got = spark.read.schema("id INT, v STRING, day DATE").parquet(table).where("day not in (DATE'2024-01-04', DATE'2024-01-05')")
    rows = {r.id: (r.v, r.day.day) for r in got.collect()}
    assert rows[0] == ("b", 2) and rows[77] == ("new", 6) and rows[5] == ("a", 1) and len(rows) == 25


def test_only_the_keys_buckets_are_read(spark, table):
    index = key_days.KeyDays(spark, table, ["id"], "day")
    asked = batch(spark, [(3, "x", 1)])
    entries, numbers = index._touched(asked)
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert len(numbers) == 1 and "_keys" in plan and "PartitionFilters: [isnotnull(bucket" in plan
    assert index.days_of(asked) == [dt.date(2024, 1, 4)]


def test_index_follows_moves_and_nulls(spark, table):
    for day in (9, None, 9, 2):
        tables.upsert_table(batch(spark, [(7, "m", day)]), table, "created_at")
        assert [r for r in stored(spark, table) if r[0] == 7] == [(7, "m", day)]
    tables.upsert_table(batch(spark, [(None, "n", 3)]), table, "created_at")
    tables.upsert_table(batch(spark, [(None, "n2", 4)]), table, "created_at")
    assert [r for r in spark.read.parquet(table).where("id is null").select("v").collect()] == [("n2",)]


def test_writers_that_do_not_know_the_keys(spark, table):
    """Days replaced or dropped by others are indexed again, with columns that they bring."""
    day = F.to_date("created_at").alias("day")
    tables.overwrite_days(batch(spark, [(500, "o", 8), (501, "o", 8)]).select("*", day, F.lit(7).alias("extra")), table, "day")
    tables.drop_day(spark, table, dt.date(2024, 1, 1), "day")
    tables.upsert_table(batch(spark, [(500, "moved", 9), (0, "again", 2)]), table, "created_at")
    rows = stored(spark, table)
    assert [r for r in rows if r[0] in (0, 500, 501)] == [(0, "again", 2), (500, "moved", 9), (501, "o", 8)]
    assert {r.id: r.extra for r in spark.read.schema("id INT, extra INT").parquet(table).where("id > 499").collect()} == {500: 7, 501: 7}
    assert key_days.file_names(spark, f"{table}/_pending") == []


def test_full_refresh_removes_the_index(spark, table):
    fresh = batch(spark, [(1, "z", 9)]).withColumn("day", F.to_date("created_at"))
    tables.overwrite_table(fresh, table, "day")
    assert not key_days.has_index(spark, table)
    tables.upsert_table(batch(spark, [(1, "y", 8)]), table, "created_at")
    assert stored(spark, table) == [(1, "y", 8)]


@pytest.mark.parametrize("broken", ["replace", "_replace"])
def test_a_failed_load_does_not_hide_rows(spark, table, monkeypatch, broken):
    """Data written and index not, and the other way round; another batch than the failed one comes next."""

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if broken == "replace":
            patch.setattr(key_days.KeyDays, "replace", fail)
        else:
            patch.setattr(tables, "_replace_days", fail)
        with pytest.raises(OSError):
            tables.upsert_table(batch(spark, [(900, "first", 3), (4, "first", 7)]), table, "created_at")
    tables.upsert_table(batch(spark, [(900, "second", 9), (4, "second", 9)]), table, "created_at")
    assert [r for r in stored(spark, table) if r[0] in (4, 900)] == [(4, "second", 9), (900, "second", 9)]
    assert len(stored(spark, table)) == 41


def test_buckets_grow(spark, table, monkeypatch):
    monkeypatch.setattr(key_days, "BUCKET_BYTES", 10)
    index = key_days.KeyDays(spark, table, ["id"], "day")
    before = index.buckets
    tables.upsert_table(batch(spark, [(3, "x", 1)]), table, "created_at")
    assert index.buckets == 2 * before
    tables.upsert_table(batch(spark, [(i, "y", 6) for i in range(40)]), table, "created_at")
    assert stored(spark, table) == [(i, "y", 6) for i in range(40)]


def test_other_keys_make_another_index(spark, table):
    tables.upsert_table(batch(spark, [(3, "a", 6)]), table, "created_at", ["id", "v"])
    assert [r for r in stored(spark, table) if r[0] == 3] == [(3, "a", 6)]
