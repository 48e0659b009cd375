"""Observed checks, changed days, positions and sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from ridelake.operators.ranking import with_position
from ridelake.operators.sketches import distinct_sketches, merged_counts
from ridelake.plans import desk
from ridelake.sources import changes, tables
from ridelake.sources.live import read_live

DAY = dt.date(2024, 1, 1)
SCHEMA = "id INT, kind STRING, date_kr DATE"


def day(n):
    return DAY + dt.timedelta(days=n)


def test_a_bad_day_is_not_published_and_read_once(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1, "a", DAY), (2, "b", DAY), (3, "a", day(1))], SCHEMA)
    good.write.parquet(str(tmp_path / "source"))
    source = spark.read.parquet(str(tmp_path / "source"))
    plans, write = [], DataFrameWriter.parquet

    def recorded(writer, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    expected = {"kinds": (F.size(F.collect_set("kind")), 2), "nobody": (F.count_if(F.col("id").isNull()), 0)}
    with pytest.raises(ValueError, match="kinds is 2 and not 9"):
        tables.refresh_day(source, path, DAY, expected={"kinds": (F.size(F.collect_set("kind")), 9)})
    assert not (tmp_path / "t").exists()
    plans.clear()
    assert tables.refresh_day(source, path, DAY, expected=expected) == "loaded"
    # The source is scanned by the staging write alone, which also observes.
    reading = [p for p in plans if "/source" in p]
    assert len(reading) == 1 and reading[0].count("FileScan") == 1 and "CollectMetrics" in reading[0]
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,)]
    assert tables.refresh_day(source, path, day(5), expected={"kinds": (F.size(F.collect_set("kind")), 0)}) == "loaded"


def test_only_changed_days_are_rebuilt(spark, tmp_path, rows):
    path, built = str(tmp_path / "t"), []
    base = [(i, "a", day(i % 6)) for i in range(60)] + [(100, "n", None)]

    def build(changed):
        built.append(sorted(str(r[0]) for r in changed.select("date_kr").distinct().collect()))
        return changed.groupBy("date_kr").agg(F.count(F.lit(1)).alias("n"))

    def refresh(items, **options):
        return changes.refresh_changed(spark.createDataFrame(items, SCHEMA).repartition(3), path, build, **options)

    def stored():
        return {r.date_kr: r.n for r in spark.read.parquet(path).collect()}

    assert refresh(base) == [*(day(n) for n in range(6)), None]
    files = sorted(p.name for p in (tmp_path / "t" / "date_kr=2024-01-02").iterdir())
    assert refresh(list(reversed(base))) == []
    assert refresh([*base, (0, "a", day(0))]) == [day(0)]  # a repeated row counts
    assert refresh([*base, (0, "a", day(0)), (999, "late", day(3))]) == [day(3)]
    assert stored() == {**{day(n): 10 for n in range(6)}, day(0): 11, day(3): 11, None: 1}
    changed = [(i, "b" if i == 7 else k, d) for i, k, d in base if d != day(5)]
    assert refresh(changed, first=day(4)) == [day(5)]  # earlier days are not looked at
    assert refresh(changed) == [day(0), day(1), day(3)]
    assert stored() == {**{day(n): 10 for n in range(5)}, None: 1}
    assert built[0][0] == "2024-01-01" and built[1:] == [["2024-01-01"], ["2024-01-04"], [], ["2024-01-01", "2024-01-02", "2024-01-04"]]
    assert sorted(p.name for p in (tmp_path / "t" / "date_kr=2024-01-02").iterdir()) != files


def test_a_failed_refresh_is_made_up_for(spark, tmp_path):
    source = spark.createDataFrame([(1, "a", DAY)], SCHEMA)

    def broken(changed):
        return changed.select("date_kr", F.raise_error(F.lit("no")).alias("n"))

    with pytest.raises(Exception, match="no"):
        changes.refresh_changed(source, str(tmp_path / "t"), broken)
    assert changes.refresh_changed(source, str(tmp_path / "t"), lambda df: df) == [DAY]
    assert changes.refresh_changed(source.limit(0), str(tmp_path / "t"), lambda df: df) == [DAY]
    assert read_live(spark, str(tmp_path / "t" / "_fingerprints"), changes.fingerprints(source).schema).isEmpty()


@pytest.mark.parametrize("ranges", [1, 7, 200])
def test_positions_are_the_global_order(spark, ranges):
    df = spark.range(3000).select(((F.col("id") * 7919) % 500).alias("a"), F.when(F.col("id") % 10 != 0, "x").alias("b"), "id")
    order = [F.desc("a"), "b", F.col("id").desc()]
    got = with_position(df, order, ranges=ranges).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 3001))
    assert [r.id for r in got] == [r.id for r in df.orderBy(*order).collect()]
    assert with_position(df.limit(0), order).collect() == []


def test_sketches_add_up(spark):
    df = spark.range(200_000).select((F.col("id") % 4).alias("day"), (F.col("id") % 30_000).alias("who"))
    stored = distinct_sketches(df, ["day"], F.col("who"))
    [row] = merged_counts(stored, [], "n").collect()
    assert abs(row.n - 30_000) < 600
    assert stored.agg(F.max(F.octet_length("sketch"))).first()[0] < 17_000


def test_stored_page_ends(spark, rows):
    pages = spark.createDataFrame([("a", 3, [1]), ("a", 1, [2]), ("b", 9, [3]), (None, 2, [4])], "load STRING, page BIGINT, users ARRAY<INT>")
    ends = spark.createDataFrame([("a", 2)], "_load STRING, _end BIGINT")
    assert rows(desk.usable_pages(pages, "users", ends), "users") == [([2],), ([3],), ([4],)]
